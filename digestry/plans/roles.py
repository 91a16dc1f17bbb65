"""Which column of the test tables plays which role.

Everything here is an adapter: projections, constants and small dimension
tables. The SQL checks use the same definitions.
"""

from __future__ import annotations

from datetime import datetime, timezone
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from digestry.config import Label, Settings, Source, Taxonomy, check_taxonomy
from digestry.functions.bind import compute_once
from digestry.functions.identity import stable_id
from digestry.functions.times import business_date
from digestry.functions.urls import normalize_url, url_host
from digestry.operators.history import history_ids
from digestry.operators.prefilter import annotate, eligible
from digestry.operators.ranking import final_order
from digestry.operators.scoring import (
    business_transferability,
    clamp,
    evidence_quality,
    final_score,
    technical_depth,
)
from digestry.operators.select_best import best_per_key
from digestry.session import stage
from digestry.sources.pages import article_text, page_title
from digestry.sources.tables import read_table

NOW = datetime(2024, 1, 31, tzinfo=timezone.utc)
NOW_SECONDS = int(NOW.timestamp())
LAST_SUCCESS = datetime(2022, 2, 2, tzinfo=timezone.utc)
SETTINGS = Settings()
SCRIPT = r"\p{L}"  # the test texts hold no CJK, so any letter counts as readable
MINIMUM_FINAL = 0.30

TAXONOMY = check_taxonomy(
    Taxonomy(
        labels=(
            Label("targets", "harbour", "港口", "Harbour", ("in the", "is the")),
            Label("targets", "reader", "读者", "Reader", ("para", "que")),
            Label("targets", "hall", "大厅", "Hall", ("und",)),
            Label("scenarios", "leaflet", "传单", "Leaflet", ("and the",)),
            Label("scenarios", "choir", "合唱", "Choir", ("pour",)),
            Label("scenarios", "market_day", "集市", "Market Day", ("thin",)),
            Label("scenarios", "neighbours", "邻居", "Neighbours", ("shon", "hand")),
            Label("tasks", "gathering", "收集", "Gathering", ("thing",)),
            Label("tasks", "choosing", "择优", "Choosing", ("tion",)),
            Label("tasks", "second_look", "复看", "Second Look", ("when",)),
            Label("methods", "paired_nets", "双网", "Paired Nets", ("thou",)),
            Label("methods", "webs", "网状", "Webs", ("thes",)),
            Label("methods", "trials", "试行", "Trials", ("thwh",)),
        ),
        collection_terms=("of the", "and the", "thing", "que", "der", "pour", "license"),
    )
)
LABEL_IDS = tuple(label.id for label in TAXONOMY.labels)
WEIGHTS = (1.0, 0.95, 0.9, 0.85, 0.8)
BLOG_WEIGHT = 0.9
SOURCES = tuple(Source(f"src{n}", "paper", WEIGHTS[n % 5], required=n == 0) for n in range(20))


# A DataFrame is a plan, so building it once per session and folder saves only planning time.
plan = lru_cache(maxsize=64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def pick(values, index: Column) -> Column:
    """Entry of a literal list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def hours_ago(key: Column, span: int) -> Column:
    return F.timestamp_seconds(F.lit(NOW_SECONDS) - (key * 7919 % span) * 3600)


def first_line(text: Column) -> Column:
    return F.substring(F.substring_index(text, "\n", 1), 1, 1000)


@plan
def paper_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_key"),
        F.lit("paper").alias("kind"),
        F.col("source").alias("source_id"),
        first_line(F.col("text")).alias("title"),
        F.lit(None).cast("string").alias("url"),
        hours_ago(F.col("doc_id"), 52560).alias("published_at"),
        F.col("text").alias("excerpt"),
        F.array("lang").alias("categories"),
        pick(WEIGHTS, F.substring("source", 4, 9).cast("int") % 5).alias("source_weight"),
    )
    return rows.withColumn("id", stable_id(F.col("title")))


@plan
def blog_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = compute_once(table(spark, sf_dir, "pages"), title=page_title(F.col("html")), address=normalize_url(F.col("url")))
    rows = pages.select(
        F.col("page_id").alias("row_key"),
        F.lit("blog").alias("kind"),
        url_host(F.col("url")).alias("source_id"),
        "title",
        F.col("address").alias("url"),
        hours_ago(F.col("page_id"), 35040).alias("published_at"),
        article_text(F.col("html")).alias("excerpt"),
        F.array().cast("array<string>").alias("categories"),
        F.lit(BLOG_WEIGHT).alias("source_weight"),
    )
    return rows.withColumn("id", stable_id(F.col("title"), F.col("url")))


@plan
def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paper_candidates(spark, sf_dir).unionByName(blog_candidates(spark, sf_dir))


@plan
def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate(candidates(spark, sf_dir), TAXONOMY, SETTINGS, NOW)


def with_excerpts(spark: SparkSession, sf_dir: str, chosen: DataFrame) -> DataFrame:
    """Rows that a cap has chosen, with their text again."""
    texts = candidates(spark, sf_dir).select("kind", "row_key", "excerpt")
    return stage(texts.join(chosen, ["kind", "row_key"]), "with-text")


@plan
def document_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paper_candidates(spark, sf_dir).select("row_key", "id")


@plan
def state_ids(spark: SparkSession, sf_dir: str, ids: DataFrame | None = None) -> DataFrame:
    """`ids`, here and below: the document ids as a staged table, for queries that need them several times."""
    return (document_ids(spark, sf_dir) if ids is None else ids).where(F.col("row_key") % 17 == 0).select("id", F.col("row_key").alias("pos"))


@plan
def digest_ids(spark: SparkSession, sf_dir: str, ids: DataFrame | None = None) -> DataFrame:
    toxic = table(spark, sf_dir, "labels").where(F.col("toxic") == 1).select(F.col("doc_id").alias("row_key"))
    return (document_ids(spark, sf_dir) if ids is None else ids).join(toxic, "row_key", "left_semi")


@plan
def history(spark: SparkSession, sf_dir: str, ids: DataFrame | None = None) -> DataFrame:
    return history_ids(state_ids(spark, sf_dir, ids), digest_ids(spark, sf_dir, ids))


@plan
def eligible_candidates(spark: SparkSession, sf_dir: str, ids: DataFrame | None = None) -> DataFrame:
    return eligible(candidates(spark, sf_dir), history(spark, sf_dir, ids), TAXONOMY, SETTINGS, NOW)


@plan
def reading_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: turns as references, answers as implications, questions as depth parts."""
    filled = F.length("text") > 0
    return (
        table(spark, sf_dir, "conversations")
        .groupBy(F.col("conv_id").alias("row_key"))
        .agg(
            F.count("*").alias("n_refs"),
            F.count_if((F.col("role") == "assistant") & filled).alias("n_implications"),
            F.count_if((F.col("role") == "user") & filled).alias("n_parts"),
        )
    )


@plan
def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_of(spark, sf_dir, eligible_candidates(spark, sf_dir))


def scored_of(spark: SparkSession, sf_dir: str, chosen: DataFrame) -> DataFrame:
    """Candidates with the parts of the final score."""
    quality = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("row_key")).agg(
        (F.max("quality") * F.lit(0.8) + F.lit(0.1)).alias("explicit")
    )
    facts = quality.join(reading_counts(spark, sf_dir), "row_key", "full_outer").withColumn("kind", F.lit("paper"))
    rows = chosen.join(facts, ["row_key", "kind"], "left")
    none = F.lit(None).cast("double")
    parts = F.coalesce("n_parts", F.lit(0)) + 1
    relevance = clamp(F.col("metadata_score"))
    return rows.withColumns(
        {
            "relevance_score": relevance,
            "evidence": evidence_quality(F.col("explicit"), F.col("n_refs")),
            "transfer": business_transferability(none, F.col("n_implications")),
            "depth": technical_depth(none, F.col("kind"), parts),
        }
    ).withColumn(
        "final_score",
        final_score(
            F.col("relevance_score"), F.col("evidence"), F.col("transfer"), F.col("depth"), SETTINGS.final_weights
        ),
    )


@plan
def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published items: every eligible candidate, labelled by rule."""
    return items_of(scored(spark, sf_dir))


def items_of(rows: DataFrame) -> DataFrame:
    return rows.select(
        "row_key", "id", "kind", "title",
        F.concat(F.lit("about "), "title").alias("summary"),
        F.col("source_id").alias("source"),
        F.coalesce("url", F.concat(F.lit("https://papers.example.org/"), "id")).alias("url"),
        "published_at",
        F.array("source_id").alias("authors"),
        "targets", "scenarios", "tasks", "methods", "relevance_score", "final_score",
        business_date(F.col("published_at")).alias("digest_date"),
    )


@plan
def archive_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_of(items(spark, sf_dir))


def archive_of(published: DataFrame) -> DataFrame:
    """Items that made the digest of their day: the best of each kind."""
    return best_per_key(
        published, ["digest_date", "kind"], final_order(), SETTINGS.daily_target, "rank"
    )


@plan
def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events tied to a document; the number of documents is a scalar subquery."""
    n_docs = table(spark, sf_dir, "documents").agg(F.max("doc_id") + 1).scalar()
    return table(spark, sf_dir, "events").withColumn("doc_id", F.col("event_id") % n_docs)


@plan
def proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct proposed labels per document; the last index is a label nobody knows."""
    names = (*LABEL_IDS, "unknown_label")
    label = pick(names, F.col("event_id") % len(names))
    return event_documents(spark, sf_dir).select(F.col("doc_id").alias("row_key"), label.alias("label")).distinct()


@plan
def relations(spark: SparkSession, sf_dir: str, ids: DataFrame | None = None) -> DataFrame:
    """Relations of documents in long form; every seventh points to a label instead of a document."""
    ids = document_ids(spark, sf_dir) if ids is None else ids
    events = event_documents(spark, sf_dir).select(
        "doc_id",
        F.col("event_id").alias("pos"),
        F.col("event_type").alias("type"),
        (F.col("user_id") * 20).alias("target_doc"),
        F.least(F.lit(1.0), F.col("value") / 100).alias("confidence"),
    )
    sources = ids.select(F.col("row_key").alias("doc_id"), "id")
    targets = ids.select(F.col("row_key").alias("target_doc"), F.col("id").alias("doc_target"))
    to_label = F.col("pos") % 7 == 0
    return (
        events.join(sources, "doc_id")
        .join(targets, "target_doc", "left")
        .select(
            "id", "pos", "type",
            F.when(to_label, pick(LABEL_IDS, F.col("pos") % len(LABEL_IDS)))
            .otherwise(F.coalesce("doc_target", F.concat(F.lit("missing-"), F.col("target_doc").cast("string"))))
            .alias("target_id"),
            "confidence",
            F.concat(F.lit("event "), F.col("pos").cast("string")).alias("evidence"),
            F.lit("model-a").alias("generated_by"),
        )
    )


def stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def day(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def joined(values: Column) -> Column:
    return F.array_join(values, " ")
