"""Snapshot frames as a change log: which frames commit, what every entity was at each commit, and what a commit touched.

Frames are few and their acceptance is sequential: an ordered fold. Changes are many and need no order of their own: with the
number of the commit that brought it, an entity's history is a matter of neighbours and of the full frames that left it out."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronotally.operators import folds
from chronotally.operators.snapshots import checkpointed

ENTITY = ("source", "collection", "id")


def commit_step(state: Any, row: tuple) -> tuple[Any, tuple]:
    """status and commit of a frame. state: (committed place, its snapshot and digest), (newest place seen, its snapshot), commits."""
    epoch, sequence, snapshot, base_epoch, base_sequence, whole, digest = row
    committed, seen, n = state or (None, None, 0)
    place, base = (epoch, sequence), (base_epoch, base_sequence)
    if committed and committed[:2] == (place, snapshot):
        return state, ("repeated" if committed[2] == digest else "changed", None)
    if base != (None, None) and (committed is None or base != committed[0]):
        return state, ("resync", None)
    if seen and place < seen[0]:
        return state, ("superseded", None)
    if seen and place == seen[0] and snapshot != seen[1]:
        return state, ("conflict", None)
    if committed and epoch == committed[0][0] and sequence <= committed[0][1]:
        return state, ("committed before", None)
    if not whole:
        return (committed, (place, snapshot), n), ("incomplete", None)
    return ((place, snapshot, digest), (place, snapshot), n + 1), ("committed", n + 1)


def commit_frames(frames: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """frames (source, epoch, sequence, snapshot, base_epoch, base_sequence, whole, digest, ...) with status and commit, the
    number of the commit within the source.

    In order of arrival a frame commits if it is whole, newer than every frame seen, and either full (no base) or based on the
    last commit. Otherwise: repeated or changed (the last commit again, with the same content or another), resync (its base is not
    the last commit), superseded (a newer frame was seen), conflict (another snapshot has its place), committed before,
    incomplete (it fences older ones, as parts of it were seen)."""
    needs = ["epoch", "sequence", "snapshot", "base_epoch", "base_sequence", "whole", "digest"]
    return folds.with_fold(frames, ["source"], order, needs, commit_step, "status string, commit long")


def entity_versions(changes: DataFrame, commits: DataFrame) -> DataFrame:
    """source, collection, id, data, since, until: what each entity was from one commit up to (not including) another.

    changes (source, snapshot, collection, id, data; null data deletes), commits (source, snapshot, commit, complete: the
    collections that the frame holds whole, null for a delta). A version ends with the entity's next change, or with a full frame
    that holds its collection whole without it. Of several changes of an entity in a frame the largest data counts."""
    known = checkpointed(commits.select("source", "snapshot", "commit", "complete"))  # three uses of one sequential fold
    rows = changes.join(known.select("source", "snapshot", "commit"), ["source", "snapshot"]).groupBy(*ENTITY, "commit").agg(F.max("data").alias("data"))
    collections = known.select("source", F.explode("complete").alias("collection")).distinct()  # others are never left out
    places = known.join(collections, "source").withColumn("_full", F.when(F.array_contains("complete", F.col("collection")), F.col("commit")))
    later = Window.partitionBy("source", "collection").orderBy(F.col("commit").desc()).rowsBetween(Window.unboundedPreceding, -1)  # a running minimum
    places = places.select("source", "collection", "commit", F.min("_full").over(later).alias("left_out"))  # a row per commit and collection
    after = F.lead("commit").over(Window.partitionBy(*ENTITY).orderBy("commit"))
    rows = rows.withColumn("after", after).join(places, ["source", "collection", "commit"], "left")
    return rows.where("data is not null").select(*ENTITY, "data", F.col("commit").alias("since"), F.least("after", "left_out").alias("until"))


def state_at(versions: DataFrame, commit: Column | None = None) -> DataFrame:
    """Entities and data as of a commit (an expression, which may depend on the source), or of the last one."""
    here = F.col("until").isNull() if commit is None else (F.col("since") <= commit) & (F.col("until").isNull() | (F.col("until") > commit))
    return versions.where(here).select(*ENTITY, "data")


def touched(versions: DataFrame, key: Column, kind: str) -> DataFrame:
    """source, commit, kind, key: keys (an expression over the data) of entities that a commit brought, changed or took away, of
    their old and their new data. A frame that repeats an entity unchanged touches nothing."""
    w = Window.partitionBy(*ENTITY).orderBy("since")
    same_before = (F.lag("until").over(w) == F.col("since")) & (F.lag("data").over(w) == F.col("data"))
    same_after = (F.lead("since").over(w) == F.col("until")) & (F.lead("data").over(w) == F.col("data"))
    rows = versions.withColumns({"_came": F.when(~F.coalesce(same_before, F.lit(False)), F.col("since")), "_went": F.when(~F.coalesce(same_after, F.lit(False)), F.col("until"))})
    rows = rows.select("source", key.alias("key"), F.explode(F.array_compact(F.array("_came", "_went"))).alias("commit"))
    return rows.where("key is not null").select("source", "commit", F.lit(kind).alias("kind"), "key").distinct()


def prune_orphans(children: DataFrame, parents: DataFrame, on: Sequence[str], version: str) -> DataFrame:
    """children with ``pruned``: null for those that stay, "orphan" where no parent has their ``on``, "version" where the parent
    is of another version. parents has one row per ``on``; a child without a version only needs a parent."""
    found = parents.select(*on, F.col(version).alias("_parent"), F.lit(True).alias("_there"))
    rows = children.join(found, list(on), "left")
    reason = F.when(F.col("_there").isNull(), "orphan").when(F.col(version).isNotNull() & ~F.col(version).eqNullSafe(F.col("_parent")), "version")
    return rows.withColumn("pruned", reason).drop("_parent", "_there")
