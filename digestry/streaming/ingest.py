"""Incremental ingest on Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from digestry.session import scratch_path


def read_files(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table, one file or a folder of files, as a stream; the schema comes from the files' footers.

    A stream starts from a folder: that of the table, or for a single file the
    one around it with all other names left out.
    """
    path = f"{folder}/{name}"
    stream = spark.readStream.schema(spark.read.parquet(path).schema)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        return stream.parquet(path)
    return stream.option("pathGlobFilter", name).parquet(folder)


def dedupe(
    stream: DataFrame, key: str = "id", time: str = "published_at", delay: str = "7 days", salt: str | None = None,
    salts: int = 16,
) -> DataFrame:
    """One row per key within the overlap window; older state is forgotten, the static history remembers.

    With a `salt` column repeats are first dropped inside `salts` groups, so a
    key with very many copies reaches the second round as a handful of rows.
    """
    marked = stream.withWatermark(time, delay)
    if salt is None:
        return marked.dropDuplicatesWithinWatermark([key])
    spread = marked.withColumn("_salt", F.pmod(F.xxhash64(salt), F.lit(salts)))
    return spread.dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt").dropDuplicatesWithinWatermark([key])


def drop_history(stream: DataFrame, history: DataFrame, key: str = "id") -> DataFrame:
    """Stream rows whose key is not in the static history."""
    return stream.join(history.select(key), key, "left_anti")


def daily_counts(stream: DataFrame, time: str, group: str, delay: str = "1 day") -> DataFrame:
    """Rows per business day and group. A day in Shanghai starts at 16:00 UTC of the day before."""
    day = F.window(time, "1 day", startTime="16 hours")
    counted = stream.withWatermark(time, delay).groupBy(day.alias("w"), group).agg(F.count("*").alias("n"))
    return counted.select(F.to_date(F.from_utc_timestamp("w.start", "Asia/Shanghai")).alias("business_date"), group, "n")


def run_to_table(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Process everything available, then return the sink as a table."""
    spark = stream.sparkSession
    sink, checkpoint = scratch_path(spark, f"{name}-sink"), scratch_path(spark, f"{name}-checkpoint")
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start(sink)
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(sink)


def run_batches(stream: DataFrame, name: str, step: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Hand every micro-batch to `step`; a batch may come again after a failure, so `step` must overwrite by batch id."""
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", scratch_path(stream.sparkSession, f"{name}-checkpoint"))
        .foreachBatch(step)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
