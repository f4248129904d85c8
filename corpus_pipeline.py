"""Training-corpus pipeline over ``documents``: toxicity, line dedup, near-duplicate removal, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and read
again as the next stage's docs. All stages but the last return the columns of documents, whatever further columns there
are and whatever their names. Repeated rows count as copies, and an empty table runs through all stages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from chronotally.llm import lines, mixing, ngram_join, packing, toxicity
from chronotally.llm.common import remove_folder, shared_folder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go. A null or empty text is never rejected; without usable labels
    nothing is."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; every document stays, with n_chars of what is left. A null text stays null, a
    text of boilerplate only becomes ''; a null source is one of its own with ''."""
    return lines.cleaned(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest doc_id (a null one comes last), and one
    of repeated rows. Texts that are null or have no word all stay."""
    return ngram_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their sources' rates, in a global random order; ties of the order go by doc_id. A null source
    counts as ''; a document may be drawn no time at all."""
    return mixing.mix(docs, counted=False)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their places in sequences of 2048 tokens. A null or empty text is the end id alone; a text longer than
    a sequence is cut, whole."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: The classifier cannot be written in SQL; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; results in between go to the folder that the session names for checkpoints, and each
    is deleted once the next one is written. The last one stays, as the result reads it."""
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = f"{folder}/{k}-{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            if before:
                remove_folder(spark, before)
            before = path
    return docs
