"""Windowing, source attachment and collection-time deduplication of candidates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestry.functions.identity import stable_id
from digestry.functions.times import window_lower
from digestry.operators.select_best import keep_best

KINDS = ("paper", "blog")


def with_stable_id(candidates: DataFrame) -> DataFrame:
    return candidates.withColumn(
        "id", stable_id(*[F.col(c) for c in ("title", "url", "arxiv_id", "doi", "source_entry_id")])
    )


def query_windows(states: DataFrame, now: datetime) -> DataFrame:
    """Window bounds for every state row and kind; a null `last_success_at` means a cold start."""
    kinds = F.explode(F.array(*[F.lit(kind) for kind in KINDS]))
    until = F.lit(now).cast("timestamp")
    return states.withColumn("kind", kinds).select(
        *states.columns,
        "kind",
        window_lower(F.col("kind"), until, F.col("last_success_at")).alias("since"),
        until.alias("until"),
    )


def check_state(states: DataFrame) -> DataFrame:
    """State rows that exist but have no `last_success_at`; any such row is an error."""
    return states.where(F.col("last_success_at").isNull())


def in_window(published_at: Column, kind: Column, now: datetime | Column, last_success_at: datetime | None) -> Column:
    """Inclusive on both ends. Written per kind with constants so that it can be pushed into the scan."""
    until = F.lit(now).cast("timestamp")
    last = F.lit(last_success_at).cast("timestamp")
    clauses = [
        (kind == name) & (published_at >= window_lower(F.lit(name), until, last)) & (published_at <= until)
        for name in KINDS
    ]
    return clauses[0] | clauses[1]


def attach_sources(candidates: DataFrame, sources: DataFrame, default_weight: float) -> DataFrame:
    """Weight and scenarios of the configured source.

    The planner knows the size of the list and broadcasts it while it is small.
    """
    dims = sources.where("enabled").select("source_id", "kind", "weight", "scenarios")
    return candidates.join(dims, ["source_id", "kind"], "left").select(
        *candidates.columns,
        F.coalesce("weight", F.lit(default_weight)).alias("source_weight"),
        F.coalesce("scenarios", F.array().cast("array<string>")).alias("source_scenarios"),
    )


def dedupe_collected(candidates: DataFrame) -> DataFrame:
    """Per id: heaviest source, then newest, then source id; the row key settles full ties."""
    return keep_best(
        candidates,
        ["id"],
        [F.col("source_weight").desc(), F.col("published_at").desc(), F.col("source_id"), F.col("row_key")],
    )
