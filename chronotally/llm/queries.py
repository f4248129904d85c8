"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronotally.llm import chat, edit_fingerprint, language, lattice, licenses, lines, merkle, mixing, ngram_join, packing, periodic, toxicity, warc
from chronotally.llm.common import table


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.classify(docs, table(spark, sf_dir, "labels")).drop("text")


def op6_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op7_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.link(table(spark, sf_dir, "embeddings"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link(table(spark, sf_dir, "documents")).drop("node")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.find_runs(periodic.planted(table(spark, sf_dir, "documents"))))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audited(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_formatting": chat.SQL, "op3_line_dedup": lines.SQL, "op4_license_scan": licenses.SQL, "op9_mix_sources": mixing.SQL, "op12_warc": warc.SQL, "op13_merkle_manifest": merkle.SQL}
