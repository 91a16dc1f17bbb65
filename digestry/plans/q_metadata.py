"""Labels, grounding, model responses, batches and the shortlist."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from digestry.config import GROUPS
from digestry.functions.times import iso_utc
from digestry.operators import metadata, prefilter
from digestry.operators.items import explode_labels
from digestry.plans import roles
from digestry.plans.catalog import query
from digestry.plans.roles import LABEL_IDS, SCRIPT, SETTINGS, joined, pick
from digestry.session import stage


def label_columns():
    return [joined(F.col(group)).alias(group) for group in GROUPS]


@query
def rule_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.annotated(spark, sf_dir).select("kind", "row_key", *label_columns())


def _grounded(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    papers = roles.annotated(spark, sf_dir).where(F.col("kind") == "paper")
    supported = explode_labels(papers, "row_key").select("row_key", "label")
    return metadata.ground_rows(roles.proposals(spark, sf_dir), supported, ["row_key", "label"])


@query
def label_grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grounded(spark, sf_dir)[0]


@query
def label_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grounded(spark, sf_dir)[1].groupBy("row_key").agg(F.count("*").alias("rejected"))


@query
def response_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per document, carrying its whole text, in seven states of disrepair."""
    key = F.col("doc_id")
    fields = [
        F.concat(F.lit("d"), key.cast("string")).alias("id"), F.col("text").alias("summary"),
        pick(LABEL_IDS, key % len(LABEL_IDS)).alias("label"), ((key % 101) / 100).alias("relevance"),
    ]
    plain = F.to_json(F.struct(*fields))
    shape = key % 7
    text = (
        F.when(shape == 0, F.concat(F.lit("```json\n"), plain, F.lit("\n```\n")))
        .when(shape == 1, F.substring(plain, F.lit(1), F.length(plain) - 1))
        .when(shape == 2, F.concat(F.lit("["), plain, F.lit("]")))
        .when(shape == 3, F.to_json(F.struct(*fields, F.lit("x").alias("prompt"))))
        .when(shape == 4, F.concat(F.lit("```\n"), plain))
        .when(shape == 5, F.concat(F.lit(" \n"), plain, F.lit("\t\n")))
        .otherwise(plain)
    )
    responses = roles.table(spark, sf_dir, "documents").select("doc_id", text.alias("output_text"))
    schema = "id string, summary string, label string, relevance double"
    parsed = metadata.parse_responses(responses, schema, metadata.RESPONSE_FIELDS, "doc_id")
    return parsed.select(
        "doc_id", "reason", "r.id", "r.label", F.md5("r.summary").alias("summary_hash"),
        F.round("r.relevance", 6).alias("relevance"),
    )


def returned_metadata(requested: DataFrame, batch_keys: list[str]) -> DataFrame:
    """Model output for the requested rows: some rows missing, doubled, blank, mislabelled or not asked for."""
    key = F.col("row_key")
    label = F.when(key % 97 == 96, F.lit("unknown_label")).otherwise(pick(LABEL_IDS, key % len(LABEL_IDS)))
    rows = requested.select(
        *batch_keys, "id", "row_key",
        F.when(key % 29 == 0, F.lit("")).otherwise(F.col("title")).alias("summary"),
        F.array(label).alias("proposed"),
        ((key * 31 % 101) / 100).alias("relevance"),
    )
    answered = rows.where(key % 31 != 0)
    doubled = rows.where(key % 43 == 0)
    stray = rows.where(key % 61 == 0).withColumn("id", F.concat(F.lit("stray-"), "id"))
    return answered.union(doubled).union(stray).drop("row_key")


@query
def batch_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eligible candidates in batches; numbering runs inside hash buckets, so no task sees them all."""
    return validated(stage(roles.eligible_candidates(spark, sf_dir), "eligible"))


def validated(eligible: DataFrame) -> DataFrame:
    keys = ["kind", "bucket", "batch"]
    rows = eligible.select(
        "id", "kind", "row_key", "title", F.substring("id", -2, 2).alias("bucket"), "metadata_score", "published_at", "source_id"
    )
    requested = metadata.assign_batches(rows, prefilter.score_order(), SETTINGS.batch_size, ["kind", "bucket"])
    return metadata.validate_batches(requested, returned_metadata(requested, keys), keys, LABEL_IDS, SCRIPT)


def resolve_top(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(resolved rows, batches) of the prefiltered candidates in their exact global order."""
    top = stage(prefilter.top_candidates(roles.eligible_candidates(spark, sf_dir), SETTINGS), "prefiltered")
    return resolve_of(spark, sf_dir, top)


def resolve_of(spark: SparkSession, sf_dir: str, top: DataFrame) -> tuple[DataFrame, DataFrame]:
    requested = metadata.assign_batches(roles.with_excerpts(spark, sf_dir, top), prefilter.score_order(), SETTINGS.batch_size)
    returned = returned_metadata(requested, ["batch"])
    batches = metadata.validate_batches(requested, returned, ["batch"], LABEL_IDS, SCRIPT)
    resolved = metadata.resolve(requested, returned, batches, ["batch"], SETTINGS.max_excerpt_chars, SCRIPT)
    return resolved, batches


def resolved_columns():
    return [
        "id", "kind", F.col("batch").cast("bigint").alias("batch"), "degraded", "summary", *label_columns(),
        F.col("label_rejections").cast("bigint").alias("label_rejections"),
        F.round("relevance_score", 6).alias("relevance"),
    ]


@query
def metadata_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_top(spark, sf_dir)[0].select(*resolved_columns())


def shortlisted(resolved: DataFrame) -> DataFrame:
    return prefilter.shortlist(resolved, SETTINGS.minimum_relevance, SETTINGS.deep_reads_per_kind)


@query
def shortlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shortlisted(resolve_top(spark, sf_dir)[0]).select(
        "id", "kind", F.col("shortlist_rank").cast("bigint").alias("shortlist_rank"),
        F.round("relevance_score", 6).alias("relevance"),
    )


@query
def stage_one_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shortlisted candidates merged with their metadata, as handed to the next stage."""
    return shortlisted(resolve_top(spark, sf_dir)[0]).select(
        "id", "kind", "source_id", "title", "url", iso_utc(F.col("published_at")).alias("published_at"),
        "summary", "degraded", F.round("relevance_score", 6).alias("relevance"), *label_columns(),
    )


