"""Final ranking, digest and reading of digests."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestry.functions.times import business_date
from digestry.operators.select_best import best_per_key

# Fixed value: the wording in front of every recommendation reason.
REASON_PREFIX = "与推荐系统研究方向相关："


def final_order() -> list[Column]:
    return [F.col("final_score").desc(), F.col("published_at").desc(), F.col("source"), F.col("id")]


def rank_items(items: DataFrame, limit: int, minimum: float = 0.0) -> DataFrame:
    """The best items per kind: the minimum applies before the limit, ranks count from one."""
    if not 0 <= minimum <= 1:
        raise ValueError("minimum_final_score must be between 0 and 1")
    return best_per_key(items.where(F.col("final_score") >= minimum), ["kind"], final_order(), limit, "rank")


def digest_entries(ranked: DataFrame, run_at: datetime) -> DataFrame:
    """Entries hold ids and a reason only; the date is the business day of the run."""
    return ranked.select(
        business_date(F.lit(run_at).cast("timestamp")).alias("digest_date"),
        "kind",
        F.col("id").alias("item_id"),
        "rank",
        F.concat(F.lit(REASON_PREFIX), F.col("summary")).alias("reason"),
    )


def resolve_digest(entries: DataFrame, items: DataFrame) -> DataFrame:
    """Entries with their item; kind has to agree."""
    return entries.join(items.withColumnRenamed("id", "item_id"), ["item_id", "kind"])


def digest_violations(entries: DataFrame, items: DataFrame) -> DataFrame:
    """Entries that break the digest contract, with the rule they break.

    Repeats are found with a grouped count joined back only for repeated keys,
    so a popular item never gathers in a window.
    """
    known = items.select(F.col("id").alias("item_id"), F.col("kind").alias("item_kind"))
    found = entries.join(known, "item_id", "left")
    rules = F.array_compact(
        F.array(
            F.when(F.col("item_kind").isNull(), F.lit("unknown_item")),
            F.when(F.col("item_kind") != F.col("kind"), F.lit("wrong_kind")),
            F.when(F.coalesce(F.col("rank"), F.lit(0)) < 1, F.lit("bad_rank")),
            F.when(F.col("digest_date").isNull(), F.lit("bad_date")),
        )
    )
    per_row = found.select("digest_date", "kind", "item_id", F.explode(rules).alias("rule"))
    repeated = entries.groupBy("digest_date", "kind", "item_id").agg(F.count("*").alias("n")).where("n > 1")
    repeats = repeated.select("digest_date", "kind", "item_id", F.lit("duplicate_item").alias("rule"))
    return per_row.union(repeats)


def latest(entries: DataFrame, date: str = "digest_date") -> DataFrame:
    """Rows of the newest date; the maximum is a one-value aggregate compared in a filter."""
    newest = entries.agg(F.max(date).alias("d")).scalar()
    return entries.where(F.col(date) == newest)
