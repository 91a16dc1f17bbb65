"""What has been recommended before."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def history_ids(state_ids: DataFrame, digest_ids: DataFrame) -> DataFrame:
    """Union of the ids in the state and in all digests. Merely stored items are not history."""
    return state_ids.select("id").union(digest_ids.select("id")).distinct()


def drop_history(candidates: DataFrame, history: DataFrame) -> DataFrame:
    """Candidates that were never recommended. Run it after deduplication: one row per id, so no hot key."""
    return candidates.join(history.select("id"), "id", "left_anti")


def merge_recommended(previous: DataFrame, entries: DataFrame, run: int) -> DataFrame:
    """Earlier ids in their order, then the new digest ids, papers before blogs.

    The order is carried by (`run`, `part`, `pos`), so no global numbering is
    needed. A minimum per id combines before the shuffle, unlike a window.
    """
    new = entries.select(
        F.col("item_id").alias("id"),
        F.lit(run).cast("bigint").alias("run"),
        F.when(F.col("kind") == "paper", F.lit(1)).otherwise(F.lit(2)).cast("bigint").alias("part"),
        F.col("rank").cast("bigint").alias("pos"),
    )
    first = F.min(F.struct("run", "part", "pos"))
    return (
        previous.select("id", "run", "part", "pos")
        .union(new)
        .groupBy("id")
        .agg(first.alias("f"))
        .select("id", "f.run", "f.part", "f.pos")
    )


def merge_source_states(previous: DataFrame, current: DataFrame) -> DataFrame:
    """New entries replace old ones by source; inside an entry a missing header keeps its earlier value."""
    old, new = previous.alias("o"), current.alias("n")
    return old.join(new, F.col("o.source_id") == F.col("n.source_id"), "full_outer").select(
        F.coalesce("n.source_id", "o.source_id").alias("source_id"),
        F.coalesce("n.cursor", "o.cursor").alias("cursor"),
        F.coalesce("n.etag", "o.etag").alias("etag"),
        F.coalesce("n.last_modified", "o.last_modified").alias("last_modified"),
        F.coalesce("n.last_success_at", "o.last_success_at").alias("last_success_at"),
    )
