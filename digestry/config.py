"""Run configuration: taxonomy, sources, weights and limits.

The taxonomy is configuration written by people and is compiled into the plan
whatever its size; the source list is small by contract (`MAX_SOURCES`). A
vocabulary that is itself data goes through `operators.terms.match_terms`.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

GROUPS = ("targets", "scenarios", "tasks", "methods")
MAX_SOURCES = 10_000


@dataclass(frozen=True)
class Label:
    group: str
    id: str
    name_zh: str
    name_en: str
    terms: tuple[str, ...]


@dataclass(frozen=True)
class Taxonomy:
    labels: tuple[Label, ...]
    collection_terms: tuple[str, ...] = ()

    def group(self, group: str) -> tuple[Label, ...]:
        return tuple(label for label in self.labels if label.group == group)

    def terms(self, *groups: str) -> tuple[str, ...]:
        """Configured terms in order; repeated terms stay repeated."""
        return tuple(term for group in groups for label in self.group(group) for term in label.terms)

    def evidence_terms(self) -> tuple[str, ...]:
        """Collection terms, or the terms of targets, scenarios and tasks when none are configured."""
        configured = tuple(term for term in self.collection_terms if term.strip())
        return configured or tuple(t for t in self.terms("targets", "scenarios", "tasks") if t.strip())

    def all_terms(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys((*self.evidence_terms(), *self.terms(*GROUPS))))

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [
            (group, order, label.id, label.name_zh, label.name_en)
            for group in GROUPS
            for order, label in enumerate(self.group(group))
        ]
        return spark.createDataFrame(rows, "grp string, ord int, id string, name_zh string, name_en string")

    def term_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(label.group, label.id, term) for label in self.labels for term in label.terms]
        return spark.createDataFrame(rows, "grp string, label_id string, term string")


@dataclass(frozen=True)
class Source:
    source_id: str
    kind: str
    weight: float
    required: bool = False
    enabled: bool = True
    scenarios: tuple[str, ...] = ()


def source_frame(spark: SparkSession, sources: Iterable[Source]) -> DataFrame:
    rows = [(s.source_id, s.kind, s.weight, s.required, s.enabled, list(s.scenarios)) for s in sources]
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: load them as a table instead")
    return spark.createDataFrame(
        rows,
        "source_id string, kind string, weight double, required boolean, enabled boolean, scenarios array<string>",
    )


@dataclass(frozen=True)
class MetadataWeights:
    topic: float = 0.30
    scenario: float = 0.25
    source: float = 0.15
    novelty: float = 0.15
    practical: float = 0.10
    recency: float = 0.05

    def total(self) -> float:
        return self.topic + self.scenario + self.source + self.novelty + self.practical + self.recency


@dataclass(frozen=True)
class FinalWeights:
    relevance: float = 0.55
    evidence: float = 0.20
    transfer: float = 0.15
    depth: float = 0.10

    def total(self) -> float:
        return self.relevance + self.evidence + self.transfer + self.depth


@dataclass(frozen=True)
class Settings:
    # The published defaults.
    daily_target: int = 10
    minimum_final_score: float = 0.50
    minimum_relevance: float = 0.65
    minimum_success_rate: float = 0.80
    max_papers: int = 100
    max_blogs: int = 50
    deep_reads_per_kind: int = 20
    batch_size: int = 8
    graph_max_nodes: int = 80
    graph_recent_days: int = 90
    max_item_bytes: int = 32768
    max_excerpt_chars: int = 4000
    warn_data_mb: int = 500
    fail_data_mb: int = 900
    context_window_tokens: int = 1_000_000
    reserved_prompt_tokens: int = 8_000
    reserved_output_tokens: int = 16_000
    metadata_weights: MetadataWeights = field(default_factory=MetadataWeights)
    final_weights: FinalWeights = field(default_factory=FinalWeights)


def taxonomy_from_dict(document: Mapping[str, Any]) -> Taxonomy:
    """Build a taxonomy from a parsed configuration document."""
    labels = tuple(
        Label(group, str(e["id"]), str(e["name_zh"]), str(e["name_en"]), tuple(map(str, e.get("terms", ()))))
        for group in GROUPS
        for e in document.get(group, ())
    )
    return check_taxonomy(Taxonomy(labels, tuple(map(str, document.get("collection_terms", ())))))


def check_taxonomy(taxonomy: Taxonomy) -> Taxonomy:
    """Label ids are unique across all groups, and the vocabulary is small enough for literals."""
    seen: set[str] = set()
    for label in taxonomy.labels:
        if label.id in seen:
            raise ValueError(f"duplicate taxonomy id: {label.id}")
        seen.add(label.id)
    return taxonomy


def check_weights(weights: MetadataWeights | FinalWeights) -> None:
    if abs(weights.total() - 1.0) > 1e-9:
        raise ValueError("weights must sum to 1")


def check_sources(sources: Iterable[Source], taxonomy: Taxonomy) -> None:
    seen: set[str] = set()
    known = {label.id for label in taxonomy.group("scenarios")}
    for source in sources:
        if source.source_id in seen:
            raise ValueError(f"duplicate source id: {source.source_id}")
        seen.add(source.source_id)
        unknown = set(source.scenarios) - known
        if unknown:
            raise ValueError(f"unknown scenario id: {sorted(unknown)[0]}")
