"""JSON scans and sinks of the canonical data, and the gated publish."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from digestry.operators.items import size_violations


class PublishRefused(RuntimeError):
    """A gate found violations; nothing was published."""


def read_json_lines(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """One object per line; blank lines are skipped and anything else fails the scan."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_json_lines(df: DataFrame, path: str, transient: Sequence[str] = ("feed_content",)) -> None:
    """Transient source text never reaches storage."""
    df.drop(*transient).write.json(path)


def read_documents(
    spark: SparkSession, folder: str, schema: str | T.StructType, multi_line: bool = True
) -> DataFrame:
    """JSON below the folder with the file's path: one object per file, or one per line where files were compacted."""
    return (
        spark.read.schema(schema)
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", True)
        .option("mode", "FAILFAST")
        .json(folder)
        .withColumn("path", F.col("_metadata.file_path"))
    )


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Paths and sizes below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")
    )


def unknown_fields(lines: DataFrame, allowed: Sequence[str], column: str = "value") -> DataFrame:
    """Keys a strict schema does not know. Spark would drop them silently, so they are looked for."""
    keys = F.array_except(F.json_object_keys(F.col(column)), F.array(*[F.lit(a) for a in allowed]))
    return lines.select(F.col(column), F.explode(keys).alias("field"))


def write_items(items: DataFrame, path: str, max_item_bytes: int, fmt: str = "json") -> None:
    """Items by kind, year and month; one document over the size limit stops the write."""
    if not size_violations(items, max_item_bytes).isEmpty():
        raise PublishRefused("item exceeds max_item_bytes")
    with_parts = items.withColumns(
        {
            "folder": F.when(F.col("kind") == "paper", F.lit("papers")).otherwise(F.lit("blogs")),
            "year": F.date_format("published_at", "yyyy"),
            "month": F.date_format("published_at", "MM"),
        }
    )
    # Rebalancing keeps the number of files near the number of months and splits a month that is too large.
    parts = ["folder", "year", "month"]
    with_parts.hint("rebalance", *parts).write.mode("overwrite").partitionBy(*parts).format(fmt).save(path)


def write_digest(entries: DataFrame, path: str) -> bool:
    """Digest partitions by date; an empty digest is not written."""
    if entries.isEmpty():
        return False
    entries.write.mode("overwrite").partitionBy("digest_date").parquet(path)
    return True


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """The graph document: nodes and edges as JSON lines side by side."""
    nodes.write.mode("overwrite").json(f"{path}/nodes")
    edges.write.mode("overwrite").json(f"{path}/edges")


def publish(
    gate: DataFrame, tables: Mapping[str, DataFrame], state: DataFrame, root: str, version: str
) -> str:
    """Write a new version once every gate passed; the state goes last and marks the version as complete.

    A refused or failed run leaves the previous state, and so the previous version, in force.
    """
    failed = [row["check"] for row in gate.where(~F.col("passed")).select("check").take(1)]
    if failed:
        raise PublishRefused(f"gate failed: {failed[0]}")
    target = f"{root}/{version}"
    for name, frame in tables.items():
        frame.write.mode("errorifexists").parquet(f"{target}/{name}")
    state.withColumn("version", F.lit(version)).write.mode("errorifexists").json(f"{root}/state/{version}")
    return target


def current_version(spark: SparkSession, root: str) -> str | None:
    """The newest version with a state; unfinished versions do not count."""
    try:
        states = spark.read.option("recursiveFileLookup", True).schema("version string").json(f"{root}/state")
    except Exception as error:  # an absent folder means that nothing was published yet
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise
    # Numbers in versions grow in length before they grow in text order: v10 comes after v9.
    return states.agg(F.max_by("version", F.struct(F.length("version"), "version")).alias("v")).first()["v"]
