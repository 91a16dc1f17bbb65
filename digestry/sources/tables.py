"""Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table. The plan above it is the same whatever the table's size."""
    return spark.read.parquet(path)
