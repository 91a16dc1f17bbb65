"""Digest per micro-batch."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from digestry.config import Settings, Taxonomy
from digestry.operators import history, prefilter, ranking
from digestry.session import stage

STATE = "id string, run bigint, part bigint, pos bigint"


def _state_path(root: str, batch_id: int) -> str:
    return f"{root}/state/batch={batch_id}"


def digest_step(
    root: str, taxonomy: Taxonomy, settings: Settings, now: datetime
) -> Callable[[DataFrame, int], None]:
    """The work of one micro-batch, safe to repeat.

    A batch reads the state of the batch before it and writes its own entries
    and, last, its own state; running it again overwrites both with the same
    rows. Nothing is remembered on the driver, so a restart continues.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        previous = (
            spark.read.schema(STATE).parquet(_state_path(root, batch_id - 1))
            if batch_id
            else spark.createDataFrame([], STATE)
        )
        top = prefilter.prefilter(batch, previous, taxonomy, settings, now).select(
            "id", "kind", F.col("source_id").alias("source"), "published_at", F.col("title").alias("summary"),
            F.col("metadata_score").alias("final_score"),
        )
        ranked = ranking.rank_items(top, settings.daily_target)
        entries = stage(ranking.digest_entries(ranked, now), "batch-entries")
        entries.write.mode("overwrite").parquet(f"{root}/entries/batch={batch_id}")
        merged = history.merge_recommended(previous, entries, batch_id + 1)
        merged.write.mode("overwrite").parquet(_state_path(root, batch_id))

    return step


def latest_state(spark: SparkSession, root: str) -> DataFrame:
    """Recommended ids after the last finished batch."""
    states = spark.read.schema(f"{STATE}, batch bigint").parquet(f"{root}/state")
    newest = states.agg(F.max("batch").alias("b")).scalar()
    return states.where(F.col("batch") == newest).select("id", "run", "part", "pos")
