"""Archive, facets, cards and related items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from digestry.config import GROUPS
from digestry.operators import ranking, related, reports, search
from digestry.plans import roles
from digestry.plans.catalog import query
from digestry.plans.q_state import entries_of
from digestry.plans.roles import NOW, TAXONOMY, day
from digestry.session import stage

ARCHIVE_QUERY = "  THE ｏｆ\tpaper"
ARCHIVE_FACETS = {"kind": ["paper", "blog"], "targets": ["harbour", "hall"], "tasks": []}
FACETS = {"kind": ["paper"], "year": ["2022", "2023"], "age": ["365d"], "methods": ["webs", "trials"], "targets": ["harbour"]}
COUNT_FACETS = {"methods": ["webs"], "kind": ["paper", "blog"]}
YEARS = tuple(str(year) for year in range(2018, 2025))


@query
def digest_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = stage(roles.items(spark, sf_dir), "items")
    return ranking.resolve_digest(entries_of(items), items.select("id", "kind", "title", "url")).select(
        day(F.col("digest_date")).alias("digest_date"), "kind", "item_id", F.col("rank").cast("bigint").alias("rank"), "title", "url"
    )


@query
def label_chips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.label_chips(roles.items(spark, sf_dir), TAXONOMY)


@query
def archive_search_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.archive_entries(spark, sf_dir).select("id", search.archive_text(TAXONOMY).alias("search_text"))


@query
def archive_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive rows for a query with odd spacing and width, newest day first."""
    found = search.archive_filter(roles.archive_entries(spark, sf_dir), TAXONOMY, ARCHIVE_QUERY, ARCHIVE_FACETS)
    return found.orderBy(F.col("digest_date").desc(), F.col("kind").desc(), "rank").select(
        "id", "kind", day(F.col("digest_date")).alias("digest_date"), F.col("rank").cast("bigint").alias("rank")
    )


@query
def archive_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per section, day and in total under label filters."""
    rows = roles.archive_entries(spark, sf_dir).where(search.matches_facets(ARCHIVE_FACETS))
    return search.archive_counts(rows).withColumn("digest_date", day(F.col("digest_date")))


@query
def facet_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = roles.items(spark, sf_dir)
    return items.where(search.matches_facets(FACETS, NOW)).select("id", "kind", "title")


@query
def search_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second page of ten results for a text query."""
    items = roles.items(spark, sf_dir)
    found = items.where(search.matches_query(search.search_form(F.concat_ws(" ", "title", "summary")), "the of"))
    return search.page(found, ranking.final_order(), 2).select("id", F.round("final_score", 6).alias("final_score"))


@query
def facet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = [("kind", k) for k in ("paper", "blog")] + [("year", y) for y in YEARS]
    options += [("age", a) for a in ("7d", "30d", "365d")]
    options += [(label.group, label.id) for group in GROUPS for label in TAXONOMY.group(group)]
    matching = roles.items(spark, sf_dir).where(search.matches_facets(COUNT_FACETS, NOW))
    return search.facet_counts(matching, spark.createDataFrame(options, "grp string, value string"), NOW)


@query
def related_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = related.related_items(stage(roles.items(spark, sf_dir), "items"))
    return found.select("id", F.col("rank").cast("bigint").alias("rank"), "related_id", F.col("shared").cast("bigint").alias("shared"))


@query
def age_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.age_counts(roles.candidates(spark, sf_dir), NOW)
