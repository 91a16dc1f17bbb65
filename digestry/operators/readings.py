"""Structured readings: content choice, budget, quality rules and reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestry.functions.text import any_text, blank_to_null, has_text, strip, token_estimate
from digestry.operators.select_best import best_per_key

# Payload fields that must never be stored.
TRANSIENT_FIELDS = (
    "source_full_text", "raw_text", "full_text", "prompt", "response", "reasoning_content", "reasoning_trace",
)


def first_content(choices: Sequence[tuple[str, Column]], last: tuple[str, Column]) -> Column:
    """(basis, body): the first choice with text, else the last resort whatever it holds."""
    picked = None
    for basis, body in choices:
        ready = F.struct(F.lit(basis).alias("basis"), strip(body).alias("body"))
        picked = F.when(has_text(body), ready) if picked is None else picked.when(has_text(body), ready)
    rest = F.struct(F.lit(last[0]).alias("basis"), last[1].alias("body"))
    return rest if picked is None else picked.otherwise(rest)


def paper_content(full_text: Column, excerpt: Column, title: Column) -> Column:
    fallback = F.when(F.coalesce(excerpt, F.lit("")) != "", excerpt).otherwise(title)
    return first_content([("mineru_full_text", full_text)], ("abstract_fallback", fallback))


def blog_content(feed: Column, second_feed: Column, article: Column, excerpt: Column, title: Column) -> Column:
    fallback = F.when(F.coalesce(excerpt, F.lit("")) != "", excerpt).otherwise(title)
    return first_content(
        [("rss_full_content", feed), ("rss_full_content", second_feed), ("article_html", article)],
        ("excerpt_fallback", fallback),
    )


def context_budget(sections: DataFrame, key: str, position: str, text: str, available: int) -> DataFrame:
    """Tokens per group and, where they fit, the assembled context in source order.

    A group over the budget fails and is never cut. Sums come first, so texts
    are gathered only for groups whose size the budget bounds.
    """
    if available <= 0:
        raise ValueError("token budget is exhausted")
    costs = sections.groupBy(key).agg(
        F.count("*").alias("n_sections"), F.sum(token_estimate(F.col(text))).alias("tokens")
    )
    totals = costs.withColumn("fits", F.col("tokens") <= available)
    ordered = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), F.col(text).alias("t"))))
    contexts = (
        sections.join(totals.where("fits").select(key), key, "left_semi")
        .groupBy(key)
        .agg(F.array_join(F.transform(ordered, lambda s: s["t"]), "\n\n").alias("context"))
    )
    return totals.join(contexts, key, "left")


def drop_transient(readings: DataFrame, basis: Column) -> DataFrame:
    """Raw payload fields removed, and the basis set by us rather than by the response."""
    return readings.drop(*TRANSIENT_FIELDS).withColumn("analysis_basis", basis)


def paper_reason(reading: Column) -> Column:
    """Why a paper reading has no content; null when it is fine."""
    tests = reading["experiments"]
    evidence = (
        any_text(F.transform(reading["evidence_refs"], lambda r: r["section"]))
        | any_text(reading["limitations_zh"])
        | any_text(tests["datasets"])
        | any_text(tests["baselines"])
        | any_text(tests["metrics"])
        | any_text(tests["findings_zh"])
    )
    return (
        F.when(~has_text(reading["problem_zh"]), F.lit("no_problem"))
        .when(~(has_text(reading["method_zh"]) | any_text(reading["contributions_zh"])), F.lit("no_method"))
        .when(~evidence, F.lit("no_evidence"))
    )


def blog_reason(reading: Column) -> Column:
    refs = reading["evidence_refs"]
    analysis = (
        has_text(reading["architecture_zh"])
        | has_text(reading["implementation_zh"])
        | any_text(reading["lessons_zh"])
        | any_text(F.transform(refs, lambda r: r["heading"]))
        | any_text(F.transform(refs, lambda r: r["section"]))
    )
    return F.when(~has_text(reading["system_context_zh"]), F.lit("no_context")).when(
        ~analysis, F.lit("no_analysis")
    )


def quality_reason(kind: Column, paper: Column, blog: Column) -> Column:
    return F.when(kind == "paper", paper_reason(paper)).otherwise(blog_reason(blog))


def failure_code(read_failed: Column, reason: Column) -> Column:
    """Only a code is kept: error texts may quote the source."""
    return F.when(read_failed, F.lit("deep_read_failed")).when(reason.isNotNull(), F.lit("invalid_deep_reading"))


def cap_per_kind(candidates: DataFrame, order: Sequence[Column], cap: int) -> DataFrame:
    return best_per_key(candidates, ["kind"], order, cap, "read_rank")


def reconcile(expected: DataFrame, succeeded: DataFrame, failed: DataFrame) -> DataFrame:
    """Per kind: are results exactly the expected ids, once each, and how many succeeded?

    A kind without attempts has a success rate of one.
    """
    attempts = (
        succeeded.select("kind", "id", F.lit(1).alias("won"))
        .unionByName(failed.select("kind", "id", F.lit(0).alias("won")))
        .groupBy("kind", "id")
        .agg(F.count("*").alias("copies"), F.sum("won").alias("won"))
    )
    wanted = expected.select("kind", "id").withColumn("wanted", F.lit(True))
    both = wanted.join(attempts, ["kind", "id"], "full_outer")
    missing, unexpected = F.col("copies").isNull(), F.col("wanted").isNull()
    tried = F.sum(F.coalesce("copies", F.lit(0)))
    return both.groupBy("kind").agg(
        F.count_if(F.col("wanted")).alias("expected"),
        tried.alias("attempted"),
        F.sum(F.coalesce("won", F.lit(0))).alias("succeeded"),
        F.count_if(missing).alias("missing"),
        F.count_if(unexpected).alias("unexpected"),
        F.count_if(F.col("copies") > 1).alias("duplicated"),
        F.min(F.when(missing, F.col("id"))).alias("first_missing"),
        F.min(F.when(unexpected, F.col("id"))).alias("first_unexpected"),
        F.when(tried > 0, F.sum(F.coalesce("won", F.lit(0))) / tried).otherwise(F.lit(1.0)).alias("success_rate"),
    )


def second_source_content(candidates: DataFrame, feed_rows: DataFrame) -> DataFrame:
    """Body from another feed of the same source by id, else address, else title.

    Later feed rows win; empty bodies do not count. Each lookup side holds one
    row per key, found with a partial aggregate rather than a window.
    """
    bodies = feed_rows.where(has_text(F.col("body"))).withColumn("body", strip(F.col("body")))

    def lookup(column: str) -> DataFrame:
        return (
            bodies.where(blank_to_null(F.col(column)).isNotNull())
            .groupBy(F.col("source_id").alias("key_source"), F.col(column).alias("key_value"))
            .agg(F.max_by("body", "feed_order").alias(f"by_{column}"))
        )

    result = candidates
    for column in ("id", "url_norm", "title_norm"):
        side = lookup(column)
        on = (F.col("source_id") == F.col("key_source")) & (F.col(column) == F.col("key_value"))
        result = result.join(side, on, "left").drop("key_source", "key_value")
    source = (
        F.when(F.col("by_id").isNotNull(), F.lit("id"))
        .when(F.col("by_url_norm").isNotNull(), F.lit("url"))
        .when(F.col("by_title_norm").isNotNull(), F.lit("title"))
    )
    body = F.coalesce("by_id", "by_url_norm", "by_title_norm")
    return result.select(*candidates.columns, source.alias("matched_by"), body.alias("body"))
