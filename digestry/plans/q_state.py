"""State merges, reports and the publish gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from digestry.config import source_frame
from digestry.operators import collect, history, quality, ranking, reports
from digestry.operators import items as item_ops
from digestry.operators.prefilter import top_candidates
from digestry.operators.select_best import duplicates
from digestry.plans import roles
from digestry.plans.catalog import query
from digestry.plans.q_metadata import resolve_of, resolve_top, shortlisted, validated
from digestry.plans.q_readings import ranked_items, reconciled
from digestry.plans.roles import NOW, SETTINGS, TAXONOMY, day, stamp
from digestry.session import stage


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entries_of(roles.items(spark, sf_dir))


def entries_of(items: DataFrame) -> DataFrame:
    return roles.archive_of(items).select("digest_date", "kind", F.col("id").alias("item_id"), "rank")


@query
def recommended_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    previous = roles.state_ids(spark, sf_dir).withColumns({"run": zero, "part": zero})
    return history.merge_recommended(previous, entries(spark, sf_dir), 1)


@query
def source_state_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    def states(rows: DataFrame, tag: str) -> DataFrame:
        number = F.substring("source_id", 4, 9).cast("int")
        newest = rows.groupBy("source_id").agg(F.max("published_at").alias("last_success_at"))
        return newest.select(
            "source_id",
            F.when(F.lit(tag) == "old", F.concat(F.lit("cursor-"), "source_id")).alias("cursor"),
            F.when(number % 3 != 0, F.concat(F.lit(f"{tag}-"), "source_id")).alias("etag"),
            F.when(number % 5 != 0, F.lit(tag)).alias("last_modified"),
            "last_success_at",
        )

    papers = roles.paper_candidates(spark, sf_dir).select("row_key", "source_id", "published_at")
    number = F.substring("source_id", 4, 9).cast("int")
    old = states(papers.where((F.col("row_key") % 2 == 0) & (number % 7 != 1)), "old")
    new = states(papers.where((F.col("row_key") % 3 == 0) & (number % 4 != 0)), "new")
    return history.merge_source_states(old, new).withColumn("last_success_at", stamp(F.col("last_success_at")))


@query
def item_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = roles.items(spark, sf_dir).select("id", "kind", "row_key")
    key = F.col("row_key")
    stored = items.where((key % 2 == 0) | (key % 3 == 0)).withColumn("version", F.lit("stored"))
    current = items.where((key % 3 == 0) | (key % 5 == 0)).withColumn("version", F.lit("current"))
    return item_ops.upsert(stored, current)


@query
def funnel_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = roles.candidates(spark, sf_dir).drop("excerpt", "categories")
    fresh = rows.where(collect.in_window(F.col("published_at"), F.col("kind"), NOW, None))
    eligible = stage(roles.eligible_candidates(spark, sf_dir), "eligible")  # the texts are read once for all stages
    top = stage(top_candidates(eligible, SETTINGS), "prefiltered")
    stages = {
        "collected": collect.dedupe_collected(fresh),
        "eligible": eligible,
        "prefiltered": top,
        "shortlisted": shortlisted(resolve_of(spark, sf_dir, top)[0]),
        "recommended": ranked_items(roles.items_of(roles.scored_of(spark, sf_dir, eligible))),
    }
    return reports.funnel(stages)


@query
def metadata_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved, batches = resolve_top(spark, sf_dir)
    counters = reports.metadata_counters(resolved, batches, SETTINGS.minimum_relevance)
    return counters.withColumn("call_success_rate", F.round("call_success_rate", 6))


@query
def success_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings per kind and metadata batches against the minimum, and the rate of the run."""
    eligible = stage(roles.eligible_candidates(spark, sf_dir), "eligible")
    readings = reconciled(eligible).select(F.col("kind").alias("name"), "succeeded", "attempted")
    batches = validated(eligible).agg(
        F.lit("metadata").alias("name"), F.count_if("ok").alias("succeeded"), F.count("*").alias("attempted")
    )
    gated = stage(reports.success_gate(readings.unionByName(batches), SETTINGS.minimum_success_rate), "rates")
    none = F.lit(None).cast("bigint")
    run = reports.run_rate(gated).select(
        F.lit("run").alias("name"), none.alias("succeeded"), none.alias("attempted"), "rate", "passed"
    )
    return gated.union(run).withColumn("rate", F.round("rate", 6))


@query
def source_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    warnings = roles.table(spark, sf_dir, "documents").where(F.col("doc_id") % 50 == 3).select(
        F.concat("source", F.lit(": HTTP "), F.col("doc_id").cast("string")).alias("warning"), F.col("doc_id").alias("pos")
    )
    return reports.source_status(source_frame(spark, roles.SOURCES), warnings)


@query
def latest_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = ranking.latest(stage(entries(spark, sf_dir), "entries"))
    return newest.select(day(F.col("digest_date")).alias("digest_date"), "kind", "item_id", F.col("rank").cast("bigint").alias("rank"))


@query
def latest_basis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models and content bases behind the newest digest."""
    rows = roles.archive_entries(spark, sf_dir).select(
        "digest_date",
        F.concat(F.lit("model-"), (F.col("row_key") % 3).cast("string")).alias("model"),
        F.when(F.col("kind") == "paper", roles.pick(quality.BASES["paper"], F.col("row_key") % 2))
        .otherwise(roles.pick(quality.BASES["blog"], F.col("row_key") % 3))
        .alias("basis"),
    )
    return ranking.latest(stage(rows, "entries")).agg(
        F.array_join(F.array_sort(F.collect_set("model")), " ").alias("models"),
        F.array_join(F.array_sort(F.collect_set("basis")), " ").alias("bases"),
    )


@query
def distinct_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.distinct_years(roles.items(spark, sf_dir)).orderBy(F.col("year").desc())


@query
def business_date_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = reports.business_days(roles.candidates(spark, sf_dir))
    return days.withColumn("business_date", day(F.col("business_date")))


@query
def publish_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks in front of a publish; the test rows break some of them."""
    items = stage(roles.items(spark, sf_dir), "items")
    digest = entries_of(items)
    blogs = roles.blog_candidates(spark, sf_dir)
    checks = {
        "duplicate_items": duplicates(items, ["id"]),
        "digest": ranking.digest_violations(digest, items),
        "long_excerpts": quality.long_excerpts(blogs, SETTINGS.max_excerpt_chars),
        "overflow": quality.overflow(items, SETTINGS.deep_reads_per_kind),
        "item_contract": quality.violations(items, "id", quality.item_rules(TAXONOMY)),
        "forbidden_files": quality.forbidden_files(blogs.select(F.col("url").alias("path"))),
    }
    return quality.publish_gate(checks)


@query
def size_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = roles.table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return reports.size_budget(docs, 1_000_000, 900 * 1024 * 1024)


