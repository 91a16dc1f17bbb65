"""Contracts, paths, sizes and text clean-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from digestry.config import GROUPS, source_frame
from digestry.functions.text import display_text, has_script
from digestry.functions.urls import public_url_reason
from digestry.operators import items as item_ops
from digestry.operators import metadata, quality, ranking
from digestry.operators.select_best import duplicates
from digestry.plans import roles
from digestry.plans.catalog import query
from digestry.plans.roles import SCRIPT, SETTINGS, TAXONOMY

ACCENTS = "[äöüéèêç]"
SIZE_LIMIT = 8192


@query
def item_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items damaged in six ways against the row contract."""
    key = F.col("row_key")
    hurt = roles.items(spark, sf_dir).withColumns(
        {
            "title": F.when(key % 19 == 0, F.lit(" ")).otherwise(F.col("title")),
            "url": F.when(key % 23 == 0, F.lit("ftp://x.example.org/")).otherwise(F.col("url")),
            "authors": F.when(key % 29 == 0, F.array(F.lit("A"), F.lit("A"))).otherwise(F.col("authors")),
            "relevance_score": F.when(key % 31 == 0, F.lit(1.5)).otherwise(F.col("relevance_score")),
            "targets": F.when(key % 37 == 0, F.array_append("targets", F.lit("nope"))).otherwise(F.col("targets")),
            "id": F.when(key % 41 == 0, F.concat(F.lit("bad "), "id")).otherwise(F.col("id")),
        }
    )
    return quality.violations(hurt, "id", quality.item_rules(TAXONOMY))


@query
def digest_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a digest entry: unknown items, wrong kinds, bad ranks and repeats."""
    key = F.col("row_key")
    rows = roles.paper_candidates(spark, sf_dir).select(
        roles.business_date(F.col("published_at")).alias("digest_date"),
        F.when(key % 41 == 0, F.lit("blog")).otherwise(F.lit("paper")).alias("kind"),
        F.col("id").alias("item_id"), (key % 12).alias("rank"), "row_key",
    )
    entries = rows.union(rows.where(key % 43 == 0)).drop("row_key")
    found = ranking.digest_violations(entries, roles.items(spark, sf_dir))
    return found.withColumn("digest_date", roles.day(F.col("digest_date")))


@query
def metadata_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("row_key")
    rows = roles.annotated(spark, sf_dir).select(
        F.concat("kind", F.lit("-"), key.cast("string")).alias("id"),
        F.when(key % 9 == 0, F.lit(None).cast("string")).when(key % 10 == 0, F.lit("123")).otherwise(F.col("title")).alias("summary"),
        F.when(key % 13 != 0, F.col("metadata_score")).alias("relevance_score"),
        F.lit(False).alias("degraded"),
        F.when(key % 37 == 0, F.array(F.lit("nope"))).otherwise(F.col("targets")).alias("targets"),
        *GROUPS[1:],
    )
    return metadata.metadata_violations(rows, TAXONOMY, "id", SCRIPT)


@query
def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates(roles.candidates(spark, sf_dir), ["id"])


@query
def path_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items against the paths they are stored under; some files were moved, renamed or misplaced."""
    key = F.col("row_key")
    folder = F.when((F.col("kind") == "paper") != (key % 17 == 0), F.lit("papers")).otherwise(F.lit("blogs"))
    month = F.date_format(F.when(key % 19 == 0, F.add_months("published_at", 1)).otherwise(F.col("published_at")), "yyyy/MM")
    name = F.when(key % 23 == 0, F.lit("renamed")).otherwise(F.col("id"))
    suffix = F.when(key % 29 == 0, F.lit(".html")).otherwise(F.lit(".json"))
    path = F.concat(F.lit("file:/data/items/"), folder, F.lit("/"), month, F.lit("/"), name, suffix)
    return quality.path_violations(roles.items(spark, sf_dir), path)


@query
def public_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page addresses in eight spellings, most of them not fit for reading from the public network."""
    host = r"^(https?://)[^/?#]+"
    spellings = F.array(
        F.col("url"),
        F.regexp_replace("url", "^https?", "gopher"),
        F.regexp_replace("url", host, "$1user:pw@h.example.org"),
        F.regexp_replace("url", host, "$1h.example.org:70000"),
        F.regexp_replace("url", host, "$1192.168.1.7"),
        F.regexp_replace("url", host, "$18.8.4.4"),
        F.regexp_replace("url", host, "$1[fe80::1]"),
        F.rpad("url", 2100, "x"),
    )
    return roles.table(spark, sf_dir, "pages").select("page_id", F.posexplode(spellings).alias("v", "u")).select(
        "page_id", F.col("v").cast("bigint").alias("variant"), public_url_reason(F.col("u")).alias("reason")
    )


@query
def script_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = roles.table(spark, sf_dir, "documents")
    return docs.where(has_script(F.col("text"), ACCENTS)).select("doc_id", "lang")


@query
def dim_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constraints of the small tables, against the sources that the data really uses."""
    sources = source_frame(spark, roles.SOURCES[:-2])
    used = roles.table(spark, sf_dir, "documents").select(F.col("source").alias("source_id")).distinct()
    unknown = used.join(sources, "source_id", "left_anti")
    weights = spark.createDataFrame(
        [("metadata_weights", SETTINGS.metadata_weights.total()), ("final_weights", SETTINGS.final_weights.total())],
        "name string, total double",
    )
    checks = {
        "unknown_source": unknown,
        "duplicate_source": duplicates(sources, ["source_id"]),
        "duplicate_label": duplicates(TAXONOMY.frame(spark), ["id"]),
        "weights": weights.where(F.abs(F.col("total") - 1) > 1e-9),
        "weight_range": sources.where(~F.col("weight").between(0, 1)),
    }
    return quality.publish_gate(checks).withColumnRenamed("check", "rule")


@query
def item_size_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = roles.table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return item_ops.size_violations(docs, SIZE_LIMIT, "doc_id").withColumn("bytes", F.col("bytes").cast("bigint"))


@query
def repeated_half_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts repeated with and without a divider, and texts with escapes."""
    part = F.col("doc_id") % 10
    text = (
        F.when(part == 0, F.concat("text", "text"))
        .when(part == 1, F.concat("text", F.lit(" \n "), "text"))
        .when(part == 2, F.concat("text", F.lit(r" 50\% of\_it \& \# \x")))
        .otherwise(F.col("text"))
    )
    clean = roles.table(spark, sf_dir, "documents").select("doc_id", display_text(text).alias("t"))
    return clean.select("doc_id", F.length("t").cast("bigint").alias("n_chars"), F.md5("t").alias("hash"))
