"""The item store, the second half of a run as one job, and its publishing."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from digestry.config import GROUPS
from digestry.operators import metadata, prefilter, readings
from digestry.operators.integrate import PreviousState, Run, StageOutputs, integrate
from digestry.plans import roles
from digestry.plans.catalog import query
from digestry.plans.roles import LABEL_IDS, MINIMUM_FINAL, NOW, SCRIPT, SETTINGS, TAXONOMY, pick
from digestry.session import scratch_path, stage
from digestry.sources.item_store import merge_items, read_items
from digestry.sources.publish import Published, current_run
from digestry.sources.publish import publish_run as publish
from digestry.sources.store import PublishRefused

MODEL = "model-a"
MINIMUM_RELEVANCE = 0.30
WARN_BYTES = SETTINGS.warn_data_mb * 1024 * 1024


@query
def item_store_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs that meet in the same months, read back: the last one to write an item wins."""
    items = stage(roles.items(spark, sf_dir), "items")
    key, root = F.col("row_key"), scratch_path(spark, "items")
    runs = {"first": (key % 2 == 0) | (key % 3 == 0), "second": (key % 3 == 0) | (key % 5 == 0), "third": key % 11 == 0}
    for name, chosen in runs.items():
        merge_items(items.where(chosen).withColumn("run", F.lit(name)), root, SETTINGS.max_item_bytes)
    return read_items(spark, root).select("id", "kind", "row_key", "run", "folder", "year", "month")


def answers(requested: DataFrame) -> DataFrame:
    """Model output that is mostly sound: the first labels that the text supports and one that it may not."""
    key, supported = F.col("row_key"), metadata.supported_labels()
    stray = F.when(key % 97 == 96, F.lit("unknown_label")).otherwise(pick(LABEL_IDS, key % len(LABEL_IDS)))
    return requested.select(
        "batch", "id", F.concat(F.lit("about "), "title").alias("summary"),
        F.array_distinct(F.concat(F.slice(supported, 1, 2), F.array(stray))).alias("proposed"),
        ((key * 31 % 101) / 100).alias("relevance"),
    )


def words(stem: str, count: Column) -> Column:
    """As many texts as told."""
    return F.transform(F.sequence(F.lit(1), F.lit(5)), lambda i: F.when(i <= count, F.concat(F.lit(f"{stem} "), i.cast("string")))).cast("array<string>")


def listed(stem: str, count: Column) -> Column:
    return F.array_compact(words(stem, count))


def reading_rows(chosen: DataFrame) -> DataFrame:
    """Readings of the chosen rows; some state their scores, the others are judged by what they hold."""
    key, text = F.col("row_key"), F.col("excerpt")
    explicit = {
        "evidence_quality": F.when(key % 4 == 1, (key % 10) / 10),
        "business_transferability": F.when(key % 5 == 0, F.lit(0.5)),
        "technical_depth": F.when(key % 6 == 0, F.lit(0.75)),
    }
    shared = [*(c.alias(n) for n, c in explicit.items()), listed("use", key % 4).alias("business_implications_zh")]
    paper = F.struct(
        F.when(key % 2 == 0, "mineru_full_text").otherwise("abstract_fallback").alias("analysis_basis"), *shared,
        F.col("title").alias("problem_zh"),
        text.alias("method_zh"),
        listed("gain", key % 3).alias("contributions_zh"),
        F.struct(listed("set", key % 2).alias("datasets"), listed("base", key % 2).alias("baselines"), listed("rate", key % 3).alias("metrics"), listed("find", key % 2).alias("findings_zh")).alias("experiments"),
        F.array(F.lit("one corpus")).alias("limitations_zh"),
        F.transform(listed("part", key % 5), lambda s: F.struct(s.alias("section"), F.lit(1).alias("page"))).alias("evidence_refs"),
    )
    blog = F.struct(
        F.when(key % 2 == 0, "article_html").otherwise("excerpt_fallback").alias("analysis_basis"), *shared,
        F.when(key % 19 != 0, F.col("title")).otherwise(F.lit(" ")).alias("system_context_zh"),
        F.when(key % 2 == 0, text).alias("architecture_zh"),
        F.lit("").alias("implementation_zh"),
        listed("lesson", key % 3 + 1).alias("lessons_zh"),
        F.transform(listed("part", key % 5), lambda s: F.struct(s.alias("heading"), s.alias("section"))).alias("evidence_refs"),
    )
    is_paper = F.col("kind") == "paper"
    return chosen.select("id", "kind", "row_key", F.when(is_paper, paper).alias("paper_reading"), F.when(~is_paper, blog).alias("blog_reading"))


def staged_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, made from their texts once: history, state and both ends of relations need them."""
    return stage(roles.document_ids(spark, sf_dir), "document-ids")


def first_half(spark: SparkSession, sf_dir: str, ids: DataFrame) -> StageOutputs:
    """What is handed to the second half: the shortlist with metadata, its readings, failures and relations."""
    top = stage(prefilter.top_candidates(roles.eligible_candidates(spark, sf_dir, ids), SETTINGS), "prefiltered")
    requested = metadata.assign_batches(roles.with_excerpts(spark, sf_dir, top), prefilter.score_order(), SETTINGS.batch_size)
    returned = answers(requested)
    batches = stage(metadata.validate_batches(requested, returned, ["batch"], LABEL_IDS, SCRIPT), "batches")
    resolved = metadata.resolve(requested, returned, batches, ["batch"], SETTINGS.max_excerpt_chars, SCRIPT)
    short = prefilter.shortlist(resolved, MINIMUM_RELEVANCE, SETTINGS.deep_reads_per_kind)
    key = F.col("row_key")
    candidates = stage(
        short.select(
            "id", "kind", "row_key", "source_id", "title", "published_at", "metadata_score", "summary", "relevance_score", "degraded", *GROUPS,
            F.coalesce("url", F.concat(F.lit("https://papers.example.org/"), "id")).alias("url"),
            F.array("source_id").alias("authors"),
            F.substring("excerpt", 1, SETTINGS.max_excerpt_chars).alias("excerpt"),
            F.when(F.col("kind") == "paper", F.concat(F.lit("a"), key.cast("string"))).alias("arxiv_id"),
            F.lit(None).cast("string").alias("doi"),
        ),
        "shortlist",
    )
    read = reading_rows(candidates).withColumn("code", readings.failure_code(key % 23 == 0, readings.quality_reason(F.col("kind"), F.col("paper_reading"), F.col("blog_reading"))))
    relations = roles.relations(spark, sf_dir, ids).join(candidates.select("id"), "id", "left_semi")
    manifests = spark.createDataFrame([(name, "run-1", "1") for name in ("first", "papers", "blogs")], "stage string, run_id string, schema_version string")
    states = candidates.groupBy("source_id").agg(F.max("published_at").alias("last_success_at"))
    return StageOutputs(
        manifests=manifests,
        candidates=candidates.drop("row_key"),
        relations=stage(relations, "relations"),
        readings=read.where("code IS NULL").drop("code", "row_key"),
        failures=read.where("code IS NOT NULL").select("id", "kind", "code"),
        batches=batches,
        warnings=candidates.where(key % 10 == 3).select(key.alias("pos"), F.concat("source_id", F.lit(": HTTP 503")).alias("warning")),
        source_states=states.select("source_id", F.lit("c").alias("cursor"), F.lit("e").alias("etag"), F.lit(None).cast("string").alias("last_modified"), "last_success_at"),
    )


def previous_state(spark: SparkSession, sf_dir: str, ids: DataFrame) -> PreviousState:
    zero = F.lit(0).cast("bigint")
    known = roles.state_ids(spark, sf_dir, ids).withColumns({"run": zero, "part": zero})
    none = F.lit(None).cast("string")
    old = spark.createDataFrame([("src0",), ("old-source",)], "source_id string").select("source_id", F.lit("before").alias("cursor"), none.alias("etag"), F.lit("then").alias("last_modified"), F.lit(roles.LAST_SUCCESS).cast("timestamp").alias("last_success_at"))
    return PreviousState(known, old)


def second_half(spark: SparkSession, sf_dir: str, given: StageOutputs, number: int, ids: DataFrame) -> Run:
    return integrate(given, previous_state(spark, sf_dir, ids), TAXONOMY, SETTINGS, NOW, number, MODEL, MINIMUM_FINAL, SCRIPT)


@query
def run_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of a run with their scores, kept relations and place in the digest."""
    ids = staged_ids(spark, sf_dir)
    run = second_half(spark, sf_dir, first_half(spark, sf_dir, ids), 1, ids)
    ranks = run.digest.select(F.col("item_id").alias("id"), F.col("rank").cast("bigint").alias("rank"), "reason")
    return run.items.join(ranks, "id", "left").select(
        "id", "kind", "source", "title", F.md5("abstract").alias("abstract_hash"), F.round("relevance_score", 6).alias("relevance"),
        F.round("final_score", 6).alias("final_score"), "rank", "reason", F.col("llm.degraded").alias("degraded"),
        F.array_join(F.transform("graph_relations", lambda r: r["target_id"]), " ").alias("targets_kept"),
        F.array_join(F.concat(*GROUPS), " ").alias("labels"),
    )


def outcome(run: Run, root: str, number: int) -> str:
    try:
        publish(run, root, number, SETTINGS.max_item_bytes, WARN_BYTES)
    except PublishRefused as refused:
        return str(refused)
    return "published"


def seen_parts(seen: Published) -> dict[str, DataFrame]:
    """What readers see of a published run, as (id, value) by part; a run that kept no item has none to show."""
    tables = seen.tables
    text = lambda *columns: F.concat_ws(" ", *columns)
    items = {} if seen.items is None else {"item": seen.items.select("id", text("folder", "year", "month").alias("value"))}
    return items | {
        "state": seen.state.select(F.col("run").cast("string").alias("id"), text(F.col("items_version"), roles.stamp(F.col("last_success_at")), F.col("size_warning").cast("string")).alias("value")),
        "digest": tables["digest"].select(F.col("item_id").alias("id"), text("kind", F.col("rank").cast("string"), "reason").alias("value")),
        "recommended": tables["recommended"].select("id", text(F.col("part").cast("string"), F.col("pos").cast("string")).alias("value")),
        "source": tables["source_states"].select(F.col("source_id").alias("id"), text("cursor", "etag", "last_modified", roles.stamp(F.col("last_success_at"))).alias("value")),
        "report": tables["report"].select(
            F.col("run").cast("string").alias("id"),
            text(*(F.col(c).cast("string") for c in ("paper_candidates", "blog_candidates", "paper_recommendations", "blog_recommendations", "llm_calls", "warnings"))).alias("value"),
        ),
        "warning": tables["warnings"].select("at", "warning").groupBy(F.col("at").alias("id")).agg(F.array_join(F.array_sort(F.collect_list("warning")), "; ").alias("value")),
    }


@query
def publish_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run is published, one of foreign stages and one without readings are refused; then what readers see.

    Rows are (part, id, value): the verdicts, the state, items, digest,
    recommended ids in order, source states, the report and warnings. The gates
    hold for the first run too: where they refuse it, readers see nothing and the
    verdicts are all there is.
    """
    root, ids = scratch_path(spark, "published"), staged_ids(spark, sf_dir)
    given = first_half(spark, sf_dir, ids)
    foreign = spark.createDataFrame([("first", "run-2", "1"), ("papers", "run-2", "1"), ("blogs", "run-1", "1")], given.manifests.schema)
    tries = {1: given, 2: replace(given, manifests=foreign), 3: replace(given, readings=given.readings.limit(0))}
    verdicts = [(str(number), outcome(second_half(spark, sf_dir, try_, number, ids), root, number)) for number, try_ in tries.items()]
    seen = current_run(spark, root)
    parts = {"verdict": spark.createDataFrame(verdicts, "id string, value string")}
    result = None
    for name, frame in (parts if seen is None else parts | seen_parts(seen)).items():
        part = frame.select(F.lit(name).alias("part"), "id", "value")
        result = part if result is None else result.unionByName(part)
    return result
