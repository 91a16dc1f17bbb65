"""Best rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """The first `k` rows of every key in a total order, with their rank from 1.

    A key that holds a large share of the table never reaches one task whole:
    only `k` rows per key leave each input partition, which Spark sees to for every
    `k` under the setting spark.sql.optimizer.windowGroupLimitThreshold of the job.
    """
    if k < 0:
        raise ValueError("limit must be non-negative")
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def keep_best(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in a total order."""
    return best_per_key(df, keys, order, 1, "_rank").drop("_rank")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)
