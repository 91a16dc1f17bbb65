"""From raw candidates to the best of each kind."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestry.config import Settings, Taxonomy
from digestry.functions.bind import compute_once
from digestry.operators.collect import dedupe_collected, in_window
from digestry.operators.history import drop_history
from digestry.operators.scoring import metadata_score
from digestry.operators.select_best import best_per_key
from digestry.operators.terms import candidate_text, collection_gate, term_hits, with_labels

NARROW = ("row_key", "kind", "id", "source_id", "title", "url", "published_at", "source_weight")


def annotate(
    candidates: DataFrame, taxonomy: Taxonomy, settings: Settings, now: datetime | Column, max_source_weight: float = 1.0,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Everything that needs the text, computed in the scan stage; the text itself is dropped here.

    What follows shuffles rows of a few hundred bytes instead of documents.
    """
    text = candidate_text(F.col("title"), F.col("excerpt"), F.col("categories"))
    texts = compute_once(candidates, _text=text)
    hits = compute_once(texts, hits=term_hits(F.col("_text"), taxonomy.all_terms()))
    scored = hits.select(
        *NARROW,
        *keep,
        "hits",
        collection_gate(F.col("hits"), taxonomy).alias("has_evidence"),
        metadata_score(
            F.col("kind"), F.col("hits"), F.col("source_weight"), F.col("published_at"), now,
            taxonomy, settings.metadata_weights, max_source_weight,
        ).alias("metadata_score"),
    )
    return with_labels(scored, taxonomy)


def eligible(
    candidates: DataFrame, history: DataFrame, taxonomy: Taxonomy, settings: Settings, now: datetime,
    last_success_at: datetime | None = None,
) -> DataFrame:
    """Windowed, annotated, deduplicated candidates outside the history and with evidence; no cap."""
    windowed = candidates.where(in_window(F.col("published_at"), F.col("kind"), now, last_success_at))
    best = dedupe_collected(annotate(windowed, taxonomy, settings, now))
    return drop_history(best, history).where("has_evidence").drop("has_evidence")


def score_order() -> list[Column]:
    return [F.col("metadata_score").desc(), F.col("published_at").desc(), F.col("source_id"), F.col("id")]


def top_candidates(scored: DataFrame, settings: Settings) -> DataFrame:
    """The configured number of rows per kind by score."""
    limit = F.when(F.col("kind") == "paper", settings.max_papers).otherwise(settings.max_blogs)
    most = max(settings.max_papers, settings.max_blogs)
    return best_per_key(scored, ["kind"], score_order(), most, "kind_rank").where(F.col("kind_rank") <= limit)


def prefilter(
    candidates: DataFrame, history: DataFrame, taxonomy: Taxonomy, settings: Settings, now: datetime,
    last_success_at: datetime | None = None,
) -> DataFrame:
    return top_candidates(eligible(candidates, history, taxonomy, settings, now, last_success_at), settings)


def shortlist(resolved: DataFrame, minimum_relevance: float, per_kind: int) -> DataFrame:
    """Relevant rows with at least one label, the best per kind."""
    labelled = sum((F.size(group) for group in ("targets", "scenarios", "tasks", "methods")), F.lit(0)) > 0
    qualified = resolved.where((F.col("relevance_score") >= minimum_relevance) & labelled)
    order = [F.col("relevance_score").desc(), F.col("published_at").desc(), F.col("source_id"), F.col("id")]
    return best_per_key(qualified, ["kind"], order, per_kind, "shortlist_rank")
