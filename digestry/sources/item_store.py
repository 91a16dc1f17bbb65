"""Canonical items by kind and month: merged on write, each merge visible as a whole or not at all."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from digestry.operators.items import json_bytes
from digestry.session import stage
from digestry.sources.store import PublishRefused

MONTH = ("folder", "year", "month")
COMMIT = "version long, folder string, year string, month string, data string, schema string"


def month_columns(kind: Column, published_at: Column) -> dict[str, Column]:
    """Where an item lives: the folder of its kind, then year and month of publication."""
    return {
        "folder": F.when(kind == "paper", F.lit("papers")).otherwise(F.lit("blogs")),
        "year": F.date_format(published_at, "yyyy"),
        "month": F.date_format(published_at, "MM"),
    }


def committed_versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the finished `version=N` folders: only those in which Spark's committer left its mark."""
    jvm = spark.sparkContext._jvm
    marks = jvm.org.apache.hadoop.fs.Path(f"{folder}/version=*/_SUCCESS")
    found = marks.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(marks) or []
    return sorted(int(re.search(r"version=(\d+)/_SUCCESS$", str(status.getPath())).group(1)) for status in found)


def current_commit(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """One row for each month of a version (the newest if none is named), or None before the first merge."""
    versions = committed_versions(spark, f"{root}/commits")
    if version is None:
        version = versions[-1] if versions else None
    elif version not in versions:
        raise ValueError(f"version {version} was never committed")
    return None if version is None else spark.read.schema(COMMIT).json(f"{root}/commits/version={version}")


def read_items(spark: SparkSession, root: str, version: int | None = None, months: Collection[tuple[str, str, str]] | None = None) -> DataFrame | None:
    """Items of a version with their month; with `months`, only those are listed and read."""
    commit = current_commit(spark, root, version)
    if commit is None:
        return None
    rows = [r for r in commit.collect() if months is None or (r["folder"], r["year"], r["month"]) in months]  # months of a calendar
    if not rows:
        return None
    schema = T.StructType.fromJson(json.loads(rows[0]["schema"]))
    paths = [f"{root}/months/data={r['data']}/folder={r['folder']}/year={r['year']}/month={r['month']}" for r in rows]
    return spark.read.schema(schema).option("basePath", f"{root}/months").parquet(*paths)


def merge_items(items: DataFrame, root: str, max_item_bytes: int, base: int | None = None, key: str = "id") -> int:
    """Write this run's items over the stored ones of the same place and id, and return the new version.

    Only months that the run touches are read and written again, each into a new
    folder; every other month keeps the files it has. The commit lists the folder
    of every month and is written last, so a run that fails before it changes
    nothing and a reader of an older version keeps a whole one. Ids are unique
    within a run and an item over the size limit refuses all of it. Runs without
    items leave the version as it is. `base` is the version that the run builds on,
    by default the newest; 0 starts from nothing. One writer at a time: the second
    of two that would commit the same number fails.
    """
    spark = items.sparkSession
    fresh = stage(items.withColumns(month_columns(F.col("kind"), F.col("published_at"))), "fresh-items")
    months = fresh.groupBy(*MONTH).agg(F.max(json_bytes(items.columns)).alias("bytes")).collect()  # months of a calendar
    if any(r["bytes"] > max_item_bytes for r in months):
        raise PublishRefused("item exceeds max_item_bytes")
    if any(r[m] is None for r in months for m in MONTH):
        raise PublishRefused("item without kind or publication date")
    repeated = fresh.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").take(1)
    if repeated:
        raise PublishRefused(f"duplicate item id: {repeated[0][key]}")
    versions = committed_versions(spark, f"{root}/commits")
    number = versions[-1] + 1 if versions else 1
    base = number - 1 if base is None else base
    touched = {tuple(r[m] for m in MONTH) for r in months}
    if not touched:
        return base
    stored = read_items(spark, root, base, touched) if base else None
    merged = fresh
    if stored is not None:
        merged = stored.drop("data").join(fresh.select(key, *MONTH), [key, *MONTH], "left_anti").unionByName(fresh, allowMissingColumns=True)
    data = uuid.uuid4().hex
    # Rebalancing keeps the number of files near the number of months and splits a month that is too large.
    merged.hint("rebalance", *MONTH).write.mode("errorifexists").partitionBy(*MONTH).parquet(f"{root}/months/data={data}")
    schema = T.StructType([f for f in merged.schema.fields if f.name not in MONTH] + [T.StructField(c, T.StringType()) for c in ("data", *MONTH)])
    before = current_commit(spark, root, base) if base else None
    kept = [] if before is None else [r for r in before.collect() if tuple(r[m] for m in MONTH) not in touched]
    rows = [(number, *month, data, schema.json()) for month in sorted(touched)] + [(number, *(r[m] for m in MONTH), r["data"], schema.json()) for r in kept]
    spark.createDataFrame(rows, COMMIT).coalesce(1).write.mode("errorifexists").json(f"{root}/commits/version={number}")
    return number
