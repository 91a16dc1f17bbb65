"""Content, readings, relations, final score and digest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from digestry.config import GROUPS
from digestry.functions.text import normalize_title
from digestry.operators import items as item_ops
from digestry.operators import metadata, ranking, readings
from digestry.plans import roles
from digestry.plans.catalog import query
from digestry.plans.roles import MINIMUM_FINAL, NOW, SCRIPT, SETTINGS, TAXONOMY, day, stamp
from digestry.session import stage
from digestry.sources.pages import article_text

AVAILABLE_TOKENS = 600
MODEL = "model-a"


@query
def page_article_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = roles.table(spark, sf_dir, "pages").select("page_id", article_text(F.col("html")).alias("t"))
    return text.select("page_id", F.length("t").cast("bigint").alias("n_chars"), F.md5("t").alias("hash"))


@query
def content_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blogs looked up in a second feed that knows a third of them by id, by address and by title each."""
    blogs = roles.blog_candidates(spark, sf_dir).select(
        "row_key", "source_id", "id", F.col("url").alias("url_norm"), normalize_title(F.col("title")).alias("title_norm"),
        F.md5("excerpt").alias("hash"),
    )
    key, third = F.col("row_key"), F.col("row_key") % 3
    feed = blogs.select(
        "source_id",
        F.when(third == 0, F.col("id")).otherwise(F.concat(F.lit("other-"), "id")).alias("id"),
        F.when(third == 1, F.col("url_norm")).alias("url_norm"),
        F.when(third == 2, F.col("title_norm")).alias("title_norm"),
        F.when(key % 10 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" body "), "hash")).alias("body"),
        key.alias("feed_order"),
    )
    late = feed.where(F.col("feed_order") % 7 == 0).withColumns(
        {"body": F.concat(F.lit("late "), F.col("feed_order").cast("string")), "feed_order": F.col("feed_order") + 1_000_000_000}
    )
    found = readings.second_source_content(blogs, feed.unionByName(late))
    return found.select("row_key", "source_id", "matched_by", "body")


@query
def content_basis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which source the reading uses, with every fallback taken by some rows."""
    part, key = F.col("row_key") % 4, F.col("row_key")
    rows = roles.candidates(spark, sf_dir)
    paper = readings.paper_content(
        F.when(part == 0, F.col("excerpt")), F.when(part != 1, F.col("excerpt")), F.col("title")
    )
    blog = readings.blog_content(
        F.when(part == 0, F.concat(F.lit(" feed "), "excerpt")),
        F.when(part == 1, F.concat(F.lit("second "), "excerpt")),
        F.when(part == 2, F.col("excerpt")),
        F.when(key % 8 == 3, F.col("excerpt")).otherwise(F.lit("")),
        F.col("title"),
    )
    picked = rows.select("kind", "row_key", F.when(F.col("kind") == "paper", paper).otherwise(blog).alias("c"))
    return picked.select("kind", "row_key", "c.basis", F.md5("c.body").alias("hash"))


@query
def context_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = roles.table(spark, sf_dir, "conversations")
    fitted = readings.context_budget(turns, "conv_id", "turn", "text", AVAILABLE_TOKENS)
    return fitted.select("conv_id", "n_sections", "tokens", "fits", F.md5("context").alias("hash"))


def sample_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings made from the lines of a document or the text of a page."""
    key, lines = F.col("row_key"), F.split("excerpt", "\n")

    def listed(value):
        return F.array_compact(F.array(value))

    nothing = F.array().cast("array<string>")
    paper = F.struct(
        F.get(lines, F.lit(0)).alias("problem_zh"),
        F.when(key % 3 != 0, F.get(lines, F.lit(1))).alias("method_zh"),
        listed(F.when(key % 2 == 0, F.get(lines, F.lit(2)))).alias("contributions_zh"),
        F.struct(*[nothing.alias(n) for n in ("datasets", "baselines", "metrics", "findings_zh")]).alias("experiments"),
        listed(F.get(lines, F.lit(3))).alias("limitations_zh"),
        F.array().cast("array<struct<section:string,page:int>>").alias("evidence_refs"),
    )
    blog = F.struct(
        F.when(key % 11 != 0, F.col("title")).alias("system_context_zh"),
        F.lit(None).cast("string").alias("architecture_zh"),
        F.lit(None).cast("string").alias("implementation_zh"),
        F.array(F.when(key % 5 == 0, F.lit(" ")).otherwise(F.col("excerpt"))).alias("lessons_zh"),
        F.array().cast("array<struct<heading:string,section:string>>").alias("evidence_refs"),
    )
    reason = readings.quality_reason(F.col("kind"), paper, blog)
    return roles.candidates(spark, sf_dir).select("kind", "row_key", "id", reason.alias("reason"))


@query
def reading_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_readings(spark, sf_dir).select("kind", "row_key", "reason")


@query
def reading_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings and failures in one table; a failure is an id and a code, nothing more."""
    code = readings.failure_code(F.col("row_key") % 23 == 0, F.col("reason"))
    return sample_readings(spark, sf_dir).select("kind", "row_key", "id", code.isNull().alias("accepted"), code.alias("code"))


@query
def reading_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconciled(stage(roles.eligible_candidates(spark, sf_dir).select("kind", "id", "row_key"), "wanted"))


def reconciled(eligible: DataFrame) -> DataFrame:
    wanted = eligible.select("kind", "id", "row_key")
    key = F.col("row_key")
    results = (
        wanted.where(key % 31 != 0)
        .union(wanted.where(key % 41 == 0))
        .union(wanted.where(key % 37 == 0).withColumn("id", F.concat(F.lit("x-"), "id")))
    )
    report = readings.reconcile(wanted, results.where(key % 5 != 0), results.where(key % 5 == 0))
    return report.withColumn("success_rate", F.round("success_rate", 6))


def stage_metadata(spark: SparkSession, sf_dir: str, eligible: DataFrame) -> DataFrame:
    """Eligible candidates with their text again; the text joins late, after selection."""
    chosen = eligible.select("kind", "row_key", "published_at", "metadata_score", *GROUPS)
    texts = roles.candidates(spark, sf_dir).select("kind", "row_key", "id", "source_id", "title", "url", "excerpt", "categories", "source_weight")
    return texts.join(chosen, ["kind", "row_key"]).withColumns(
        {
            "degraded": F.col("row_key") % 2 == 0,
            "summary": F.when(F.col("row_key") % 9 != 0, F.col("title")),
            "arxiv_id": F.concat(F.lit("a"), F.col("row_key").cast("string")),
            "doi": F.lit(None).cast("string"),
        }
    )


@query
def item_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = stage(roles.eligible_candidates(spark, sf_dir), "eligible")
    read = sample_readings(spark, sf_dir).where(F.col("row_key") % 31 != 0).select("id", "kind", F.col("row_key").alias("reading_key"))
    own = read.join(chosen.select("id", F.col("row_key").alias("reading_key")), ["id", "reading_key"], "left_semi")
    assembled = item_ops.assemble(own, stage_metadata(spark, sf_dir, chosen), MODEL, NOW)
    return assembled.select(
        "id", "kind", "source", "title", F.md5("abstract").alias("abstract_hash"), "arxiv_id", "doi", "reading_key",
        F.col("llm.model").alias("model"), stamp(F.col("llm.generated_at")).alias("generated"), F.col("llm.degraded").alias("degraded"),
    )


@query
def orphan_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = item_ops.orphan_readings(sample_readings(spark, sf_dir), roles.eligible_candidates(spark, sf_dir))
    return found.select("id", "kind", "row_key")


@query
def publishable_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = roles.eligible_candidates(spark, sf_dir).withColumns(
        {"degraded": F.col("row_key") % 2 == 0, "summary": F.when(F.col("row_key") % 9 != 0, F.col("title"))}
    )
    return rows.where(metadata.publishable(SCRIPT)).select("id", "kind", "row_key", "degraded")


def marked_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = stage(roles.items(spark, sf_dir).select("id"), "item-ids")
    own = roles.relations(spark, sf_dir).join(items, "id", "left_semi")
    return item_ops.mark_relations(own, item_ops.allowed_targets(items, TAXONOMY.frame(spark)))


@query
def relation_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = marked_relations(spark, sf_dir).where("kept")
    return kept.select("id", "pos", "type", "target_id", F.round("confidence", 6).alias("confidence"))


@query
def relation_prune_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return item_ops.pruning_warnings(marked_relations(spark, sf_dir))


@query
def final_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = ("relevance_score", "evidence", "transfer", "depth", "final_score")
    return roles.scored(spark, sf_dir).select("id", "kind", *[F.round(p, 6).alias(p) for p in parts])


def ranked_items(items: DataFrame) -> DataFrame:
    return ranking.rank_items(items, SETTINGS.daily_target, MINIMUM_FINAL)


@query
def final_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_items(roles.items(spark, sf_dir)).select(
        "id", "kind", F.col("rank").cast("bigint").alias("rank"), F.round("final_score", 6).alias("final_score")
    )


@query
def digest_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = ranking.digest_entries(ranked_items(roles.items(spark, sf_dir)), NOW)
    return entries.select(day(F.col("digest_date")).alias("digest_date"), "kind", "item_id", F.col("rank").cast("bigint").alias("rank"), "reason")
