"""Metadata score and final score."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from digestry.config import FinalWeights, MetadataWeights, Taxonomy
from digestry.functions.times import age_days
from digestry.operators.terms import term_coverage

# Days until the recency part reaches zero.
RECENCY_DAYS = {"paper": 1825.0, "blog": 1095.0}


def clamp(value: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))


def topic_relevance(hits: Column, taxonomy: Taxonomy) -> Column:
    return term_coverage(hits, taxonomy.terms("targets", "tasks", "methods"))


def scenario_relevance(hits: Column, taxonomy: Taxonomy) -> Column:
    return term_coverage(hits, taxonomy.terms("scenarios"))


def recency(kind: Column, published_at: Column, now: Column) -> Column:
    horizon = F.when(kind == "blog", F.lit(RECENCY_DAYS["blog"])).otherwise(F.lit(RECENCY_DAYS["paper"]))
    return clamp(F.lit(1.0) - age_days(published_at, now) / horizon)


def metadata_score(
    kind: Column, hits: Column, source_weight: Column, published_at: Column, now: datetime | Column,
    taxonomy: Taxonomy, weights: MetadataWeights, max_source_weight: float, in_history: Column | None = None,
) -> Column:
    """Six weighted parts. Novelty is one unless the caller still has history rows in the frame."""
    topic, scenario = topic_relevance(hits, taxonomy), scenario_relevance(hits, taxonomy)
    novelty = F.lit(1.0) if in_history is None else F.when(in_history, F.lit(0.0)).otherwise(F.lit(1.0))
    practical = F.least(F.lit(1.0), (topic + scenario) / F.lit(2.0))
    return (
        F.lit(weights.topic) * topic
        + F.lit(weights.scenario) * scenario
        + F.lit(weights.source) * clamp(source_weight / F.lit(max_source_weight))
        + F.lit(weights.novelty) * novelty
        + F.lit(weights.practical) * practical
        + F.lit(weights.recency) * recency(kind, published_at, F.lit(now).cast("timestamp"))
    )


def bounded_count(count: Column, denominator: int) -> Column:
    return F.least(F.lit(1.0), F.coalesce(count, F.lit(0)) / F.lit(float(denominator)))


def count_text(values: Column) -> Column:
    """Number of non-empty entries."""
    return F.size(F.filter(F.coalesce(values, F.array().cast("array<string>")), lambda v: v != ""))


def flag(value: Column) -> Column:
    return F.when(F.coalesce(value, F.lit("")) != "", F.lit(1)).otherwise(F.lit(0))


def evidence_quality(explicit: Column, references: Column) -> Column:
    return F.coalesce(explicit, bounded_count(references, 3))


def business_transferability(explicit: Column, implications: Column) -> Column:
    return F.coalesce(explicit, bounded_count(implications, 3))


def technical_depth(explicit: Column, kind: Column, parts: Column) -> Column:
    return F.coalesce(explicit, F.when(kind == "paper", bounded_count(parts, 6)).otherwise(bounded_count(parts, 4)))


def paper_depth_parts(reading: Column) -> Column:
    experiments = reading["experiments"]
    return (
        flag(reading["problem_zh"]) + flag(reading["method_zh"]) + count_text(reading["contributions_zh"])
        + count_text(experiments["datasets"]) + count_text(experiments["metrics"])
    )


def blog_depth_parts(reading: Column) -> Column:
    return (
        flag(reading["system_context_zh"]) + flag(reading["architecture_zh"])
        + flag(reading["implementation_zh"]) + count_text(reading["lessons_zh"])
    )


def final_score(
    relevance: Column, evidence: Column, transfer: Column, depth: Column, weights: FinalWeights | None
) -> Column:
    """Weighted final score; without weights it is the relevance."""
    if weights is None:
        return relevance
    return clamp(
        F.lit(weights.relevance) * relevance
        + F.lit(weights.evidence) * evidence
        + F.lit(weights.transfer) * transfer
        + F.lit(weights.depth) * depth
    )


