"""The second half of a run as one job: readings and metadata to items, digest, state, report and gates."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestry.config import Settings, Taxonomy
from digestry.functions.text import CJK
from digestry.operators import history, items, metadata, quality, ranking, readings, reports, scoring
from digestry.operators.select_best import duplicates
from digestry.session import stage


@dataclass(frozen=True)
class StageOutputs:
    """What the first half and the two reading jobs hand over.

    `manifests` (stage, run_id, schema_version); `candidates`: shortlisted rows
    with their metadata and excerpt; `relations` in long form (id, pos, type,
    target_id, confidence, ...); `readings` (id, kind, paper_reading, blog_reading)
    and `failures` (id, kind, code); `batches` (ok) of the metadata calls;
    `warnings` (pos, warning); `source_states`.
    """

    manifests: DataFrame
    candidates: DataFrame
    relations: DataFrame
    readings: DataFrame
    failures: DataFrame
    batches: DataFrame
    warnings: DataFrame
    source_states: DataFrame


@dataclass(frozen=True)
class PreviousState:
    """State before the run: `recommended` (id, run, part, pos) and `source_states`."""

    recommended: DataFrame
    source_states: DataFrame


@dataclass(frozen=True)
class Run:
    """Results of a run, ready to publish if every row of `gate` has passed."""

    gate: DataFrame
    items: DataFrame
    digest: DataFrame
    recommended: DataFrame
    source_states: DataFrame
    report: DataFrame
    warnings: DataFrame


def reading_scores(rows: DataFrame, settings: Settings) -> DataFrame:
    """Final score from relevance and the item's own reading: its stated scores, else counts of what it holds."""
    is_paper = F.col("kind") == "paper"
    paper, blog = F.col("paper_reading"), F.col("blog_reading")

    def either(name: str):
        return F.when(is_paper, paper[name]).otherwise(blog[name])

    refs = F.when(is_paper, F.size(paper["evidence_refs"])).otherwise(F.size(blog["evidence_refs"]))
    parts = F.when(is_paper, scoring.paper_depth_parts(paper)).otherwise(scoring.blog_depth_parts(blog))
    return rows.withColumns(
        {
            "evidence": scoring.evidence_quality(either("evidence_quality"), refs),
            "transfer": scoring.business_transferability(either("business_transferability"), scoring.count_text(either("business_implications_zh"))),
            "depth": scoring.technical_depth(either("technical_depth"), F.col("kind"), parts),
        }
    ).withColumn(
        "final_score",
        scoring.final_score(F.col("relevance_score"), F.col("evidence"), F.col("transfer"), F.col("depth"), settings.final_weights),
    )


def prune_relations(assembled: DataFrame, relations: DataFrame, taxonomy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items with their kept relations in order, warnings): targets are this run's items and the labels.

    Degraded rows have no relations of their own. An item's kept relations become
    one array of the item, as it is stored; a run holds a bounded number of items.
    """
    of_items = relations.join(assembled.where(~F.col("llm.degraded")).select("id"), "id", "left_semi")
    marked = stage(items.mark_relations(of_items, items.allowed_targets(assembled, taxonomy)), "marked")
    fields = [c for c in relations.columns if c not in ("id", "pos")]
    listed = F.array_sort(F.collect_list(F.struct("pos", *fields)))
    kept = marked.where("kept").groupBy("id").agg(F.transform(listed, lambda r: F.struct(*(r[f].alias(f) for f in fields))).alias("graph_relations"))
    joined = assembled.join(kept, "id", "left")
    empty = F.array().cast(dict(kept.dtypes)["graph_relations"])
    warnings = items.pruning_warnings(marked).select(
        "id",
        F.concat(
            F.lit("pruned "), F.col("pruned").cast("string"), F.lit(" graph relation(s) with unknown target id(s) from "), F.col("id"),
            F.lit(" (first: "), F.col("first_target"), F.lit(")"),
        ).alias("warning"),
    )
    return joined.withColumn("graph_relations", F.coalesce("graph_relations", empty)), warnings


def rate_rows(reconciled: DataFrame, batches: DataFrame) -> DataFrame:
    """(name, succeeded, attempted) of both kinds and of the metadata batches; a kind without rows counts as whole."""
    kinds = reconciled.select(F.col("kind").alias("name"), "succeeded", "attempted")
    calls = batches.agg(F.lit("metadata").alias("name"), F.count_if("ok").alias("succeeded"), F.count("*").alias("attempted"))
    return kinds.unionByName(calls)


def integrate(
    given: StageOutputs, previous: PreviousState, taxonomy: Taxonomy, settings: Settings, run_at: datetime, run: int, model: str,
    minimum_final: float | None = None, script: str = CJK,
) -> Run:
    """Items, digest, state and report of one run, and the checks that decide whether they may be published.

    Readings join the metadata they were asked for; degraded rows that cannot be
    shown are left out but stay attempted. Relations lose unknown targets, items
    are scored from their readings and ranked by kind, the digest takes those over
    the minimum, and its ids go behind the earlier ones. The first half caps its
    output per kind, so all tables here are small; each is written once and shared
    by the checks, which count broken rows instead of stopping at the first.
    """
    candidates, results = stage(given.candidates, "candidates"), stage(given.readings, "readings")
    failures = stage(given.failures, "failures")
    labels = taxonomy.frame(candidates.sparkSession)
    read = candidates.join(results.select("id"), "id", "left_semi")
    shown = stage(read.where(metadata.publishable(script)), "shown")
    assembled = items.assemble(results.dropDuplicates(["id"]), shown.dropDuplicates(["id"]), model, run_at)
    pruned, pruning = prune_relations(stage(assembled, "assembled"), given.relations, labels)
    finished = stage(reading_scores(pruned, settings).drop("evidence", "transfer", "depth"), "finished")

    reconciled = stage(readings.reconcile(candidates, results, failures), "reconciled")
    rates = stage(reports.success_gate(rate_rows(reconciled, given.batches), settings.minimum_success_rate), "rates")
    minimum = settings.minimum_final_score if minimum_final is None else minimum_final
    ranked = ranking.rank_items(finished, settings.daily_target, minimum)
    digest = stage(ranking.digest_entries(ranked, run_at), "digest")

    checks: Mapping[str, DataFrame] = {
        "manifests": quality.manifest_violations(given.manifests),
        "duplicate_candidates": duplicates(candidates, ["id"]),
        "metadata_rate": rates.where("name = 'metadata' AND NOT passed"),
        "overflow": quality.overflow(candidates, settings.deep_reads_per_kind),
        "orphan_readings": items.orphan_readings(results, candidates),
        "metadata": metadata.metadata_violations(shown, taxonomy, script=script),
        "long_excerpts": quality.long_excerpts(shown, settings.max_excerpt_chars),
        "item_contract": quality.violations(finished, "id", quality.item_rules(taxonomy)),
        "reading_basis": finished.where(~F.coalesce(quality.basis_rule(F.col("kind"), F.coalesce("paper_reading.analysis_basis", "blog_reading.analysis_basis")), F.lit(False))),
        "duplicate_readings": reconciled.where("duplicated > 0"),
        "reading_results": reconciled.where("missing > 0 OR unexpected > 0"),
        "reading_rate": rates.where("name <> 'metadata' AND NOT passed"),
        "item_size": items.size_violations(finished, settings.max_item_bytes),
        "digest": ranking.digest_violations(digest, finished),
    }
    warnings = given.warnings.select(F.lit(0).alias("part"), F.col("pos").cast("string").alias("at"), "warning").unionByName(
        pruning.select(F.lit(1).alias("part"), F.col("id").alias("at"), "warning")
    )
    of_kind = {kind: F.count_if(F.col("kind") == kind) for kind in ("paper", "blog")}
    counts = finished.agg(of_kind["paper"].alias("paper_candidates"), of_kind["blog"].alias("blog_candidates"))
    chosen = digest.agg(of_kind["paper"].alias("paper_recommendations"), of_kind["blog"].alias("blog_recommendations"))
    whole = reports.run_rate(rates).select(F.col("rate").alias("success_rate"))
    calls = given.batches.agg(F.count("*").alias("llm_calls"))
    said = warnings.agg(F.count("*").alias("warnings"))
    row = [frame.first().asDict() for frame in (counts, chosen, whole, calls, said)]  # one row each
    fields = {"run": run, "started_at": run_at} | {k: v for part in row for k, v in part.items()}
    report = candidates.sparkSession.createDataFrame(
        [tuple(fields.values())],
        "run long, started_at timestamp, paper_candidates long, blog_candidates long, paper_recommendations long, blog_recommendations long, "
        "success_rate double, llm_calls long, warnings long",
    )
    return Run(
        gate=stage(quality.publish_gate(checks), "gate"),
        items=finished,
        digest=digest,
        recommended=history.merge_recommended(previous.recommended, digest, run),
        source_states=history.merge_source_states(previous.source_states, given.source_states),
        report=report,
        warnings=warnings,
    )

