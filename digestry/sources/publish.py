"""Publishing a run: gates first, tables next, the state last."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from digestry.operators.integrate import Run
from digestry.operators.ranking import digest_violations
from digestry.session import stage
from digestry.sources.item_store import committed_versions, merge_items, read_items
from digestry.sources.store import PublishRefused

STATE = "run long, items_version long, last_success_at timestamp, bytes long, size_warning boolean"
TABLES = ("digest", "recommended", "source_states", "report", "warnings")


@dataclass(frozen=True)
class Published:
    """The newest complete run of a root: its number, item version and tables."""

    run: int
    state: DataFrame
    items: DataFrame | None
    tables: dict[str, DataFrame]


def current_run(spark: SparkSession, root: str) -> Published | None:
    """What readers see: the run with the newest finished state, None before the first one.

    Reports and warnings are those of all runs up to it, digests too, where a later
    run of a day replaces an earlier one; recommended ids and source states are the
    newest ones. Tables of runs without a state do not count.
    """
    runs = committed_versions(spark, f"{root}/state")
    if not runs:
        return None
    newest = runs[-1]
    state = spark.read.schema(STATE).json(f"{root}/state/version={newest}")
    version = state.first()["items_version"]

    def read(name: str) -> DataFrame:
        wanted = runs if name in ("digest", "report", "warnings") else [newest]
        return spark.read.option("basePath", f"{root}/{name}").parquet(*(f"{root}/{name}/version={r}" for r in wanted))

    tables = {name: read(name) for name in TABLES}
    tables["digest"] = last_of_day(tables["digest"])
    return Published(newest, state, read_items(spark, root, version) if version else None, tables)


def last_of_day(entries: DataFrame) -> DataFrame:
    """Entries (with the `version` of their run) of the newest run that has any for their day."""
    newest = entries.groupBy(F.col("digest_date").alias("_day")).agg(F.max("version").alias("_newest"))
    return entries.join(newest, (F.col("digest_date") == F.col("_day")) & (F.col("version") == F.col("_newest"))).drop("_day", "_newest")


def stored_bytes(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.getContentSummary(folder).getLength() if system.exists(folder) else 0


def publish_run(run: Run, root: str, number: int, max_item_bytes: int, warn_bytes: int) -> Published:
    """Make a run visible as a whole, or refuse it and leave the run before it in force.

    The gate and the number (which must be newer than the published one) are
    looked at before anything is written. Items are merged into their months; the
    digest, the merged recommendations and source states, the report and the
    warnings are written below the run's number. The digests of all runs must
    refer to stored items of their kind, or the run stays unpublished. The state
    goes last: readers take item version and tables from it alone, so what a run
    wrote before it failed is never read, and its number can be tried again.
    """
    spark = run.items.sparkSession
    failed = sorted(r["check"] for r in run.gate.where(~F.col("passed")).select("check").collect())  # one row for each check
    if failed:
        raise PublishRefused(f"gate failed: {', '.join(failed)}")
    before = current_run(spark, root)
    if before is not None and number <= before.run:
        raise PublishRefused(f"run {number} is not newer than the published run {before.run}")
    base = before.state.first()["items_version"] if before is not None else 0
    version = merge_items(run.items, root, max_item_bytes, base)
    for name in TABLES:
        getattr(run, name).write.mode("overwrite").parquet(f"{root}/{name}/version={number}")
    entries = spark.read.parquet(f"{root}/digest/version={number}").withColumn("version", F.lit(number))
    every = entries if before is None else last_of_day(before.tables["digest"].unionByName(entries))
    stored = read_items(spark, root, version) if version else run.items
    broken = digest_violations(stage(every, "entries"), stored.select("id", "kind")).take(1)
    if broken:
        raise PublishRefused(f"digest refers to a missing item: {broken[0]['item_id']}")
    size = stored_bytes(spark, root)
    at = run.report.select(F.lit(number).cast("long").alias("run"), F.lit(version).cast("long").alias("items_version"), F.col("started_at").alias("last_success_at"))
    state = at.withColumns({"bytes": F.lit(size).cast("long"), "size_warning": F.lit(size > warn_bytes)})
    state.coalesce(1).write.mode("errorifexists").json(f"{root}/state/version={number}")
    return current_run(spark, root)
