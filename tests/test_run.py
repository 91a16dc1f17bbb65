"""Item store and publishing: merges over several runs, refused and broken runs."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from digestry.config import Label, Settings, Taxonomy
from digestry.operators.integrate import PreviousState, StageOutputs, integrate
from digestry.session import scratch_path
from digestry.sources.item_store import committed_versions, merge_items, read_items
from digestry.sources.publish import current_run, publish_run
from digestry.sources.store import PublishRefused

ITEM = "id string, kind string, published_at timestamp, value string"
LIMIT = 10_000
DAY = datetime(2024, 3, 5, tzinfo=timezone.utc)


def test_months_are_merged_and_older_versions_stay_whole(spark):
    root, draw, want, seen = scratch_path(spark, "store"), random.Random(3), {}, []
    places = {f"i{k}": (draw.choice(["paper", "blog"]), datetime(2023 + k % 2, 1 + k % 5, 3, tzinfo=timezone.utc)) for k in range(40)}
    for run in range(5):
        chosen = draw.sample(sorted(places), 12)
        assert merge_items(spark.createDataFrame([(i, *places[i], f"run {run}") for i in chosen], ITEM), root, LIMIT) == run + 1
        want = want | {i: f"run {run}" for i in chosen}
        seen.append(dict(want))
    for version, state in enumerate(seen, 1):
        rows = read_items(spark, root, version).collect()
        assert {r["id"]: r["value"] for r in rows} == state and len(rows) == len(state)
        assert all((r["folder"], r["year"], r["month"]) == (places[r["id"]][0] + "s", f"{places[r['id']][1]:%Y}", f"{places[r['id']][1]:%m}") for r in rows)
    some = read_items(spark, root, months={("papers", "2023", "01")})
    assert {r["id"] for r in some.collect()} == {i for i in want if places[i] == ("paper", datetime(2023, 1, 3, tzinfo=timezone.utc))}


def test_untouched_months_keep_their_files(spark):
    root = scratch_path(spark, "store")
    merge_items(spark.createDataFrame([("a", "paper", DAY, "1"), ("b", "blog", DAY - timedelta(days=60), "1")], ITEM), root, LIMIT)
    merge_items(spark.createDataFrame([("a", "paper", DAY, "2")], ITEM).withColumn("more", F.lit(5)), root, LIMIT)
    data = {r["id"]: (r["data"], r["value"], r["more"]) for r in read_items(spark, root).collect()}
    first = {r["id"]: r["data"] for r in read_items(spark, root, 1).collect()}
    assert data["b"] == (first["b"], "1", None) and data["a"][0] != first["a"] and data["a"][1:] == ("2", 5)


def test_what_was_never_committed_is_not_read(spark):
    root = scratch_path(spark, "store")
    one = spark.createDataFrame([("a", "paper", DAY, "1")], ITEM)
    assert read_items(spark, root) is None and merge_items(one.limit(0), root, LIMIT) == 0
    merge_items(one, root, LIMIT)
    one.write.parquet(f"{root}/months/data=lost/folder=papers/year=2024/month=03")
    spark.createDataFrame([("x",)], "version string").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").json(f"{root}/commits/version=2")
    assert committed_versions(spark, f"{root}/commits") == [1]
    assert [r["value"] for r in read_items(spark, root).collect()] == ["1"]
    with pytest.raises(ValueError):
        read_items(spark, root, 2)


@pytest.mark.parametrize("rows", [[("a", "paper", DAY, "1"), ("a", "blog", DAY, "2")], [("a", "paper", DAY, "x" * LIMIT)], [("a", "paper", None, "1")]])
def test_bad_runs_are_refused(spark, rows):
    root = scratch_path(spark, "store")
    with pytest.raises(PublishRefused):
        merge_items(spark.createDataFrame(rows, ITEM), root, LIMIT)
    assert read_items(spark, root) is None


TAXONOMY = Taxonomy(tuple(Label(group, name, "名", "n", ("x",)) for group, name in (("targets", "t1"), ("scenarios", "s1"), ("tasks", "k1"), ("methods", "m1"))), ("x",))
SCORES = "evidence_quality: double, business_transferability: double, technical_depth: double, business_implications_zh: array<string>"
PAPER = (
    f"struct<analysis_basis: string, {SCORES}, problem_zh: string, method_zh: string, contributions_zh: array<string>, "
    "experiments: struct<datasets: array<string>, baselines: array<string>, metrics: array<string>, findings_zh: array<string>>, "
    "limitations_zh: array<string>, evidence_refs: array<struct<section: string, page: int>>>"
)
BLOG = (
    f"struct<analysis_basis: string, {SCORES}, system_context_zh: string, architecture_zh: string, implementation_zh: string, "
    "lessons_zh: array<string>, evidence_refs: array<struct<heading: string, section: string>>>"
)
CANDIDATE = (
    "id string, kind string, source_id string, title string, url string, published_at timestamp, authors array<string>, excerpt string, arxiv_id string, doi string, "
    "summary string, targets array<string>, scenarios array<string>, tasks array<string>, methods array<string>, relevance_score double, degraded boolean, metadata_score double"
)
RELATION = "id string, pos long, type string, target_id string, confidence double"


def candidate(k, kind="paper", degraded=False, summary="中文", **more):
    values = dict(
        id=f"{kind}{k}", kind=kind, source_id="s", title=f"T{k}", url="https://a.org/x", published_at=DAY - timedelta(days=k), authors=["a"], excerpt="e", arxiv_id="1", doi=None,
        summary=summary, targets=["t1"], scenarios=["s1"], tasks=["k1"], methods=["m1"], relevance_score=0.8, degraded=degraded, metadata_score=0.5,
    )
    return values | more


def outputs(spark, rows, failed=(), unread=(), relations=(), batches=((True,),)):
    def reading(r):
        shared = dict(evidence_quality=None, business_transferability=0.5, technical_depth=None, business_implications_zh=[])
        paper = dict(analysis_basis="abstract_fallback", **shared, problem_zh="p", method_zh="m", contributions_zh=["c", ""], experiments=dict(datasets=["d"], baselines=[], metrics=[], findings_zh=[]), limitations_zh=[], evidence_refs=[dict(section="s", page=1)])
        blog = dict(analysis_basis="article_html", **shared, system_context_zh="c", architecture_zh="a", implementation_zh="", lessons_zh=["l"], evidence_refs=[])
        return (r["id"], r["kind"], paper if r["kind"] == "paper" else None, blog if r["kind"] == "blog" else None)

    names = [f.split()[0] for f in CANDIDATE.split(", ")]
    return StageOutputs(
        manifests=spark.createDataFrame([(s, "r", "1") for s in "abc"], "stage string, run_id string, schema_version string"),
        candidates=spark.createDataFrame([tuple(r[n] for n in names) for r in rows], CANDIDATE),
        relations=spark.createDataFrame(list(relations), RELATION),
        readings=spark.createDataFrame([reading(r) for r in rows if r["id"] not in failed and r["id"] not in unread], f"id string, kind string, paper_reading {PAPER}, blog_reading {BLOG}"),
        failures=spark.createDataFrame([(r["id"], r["kind"], "deep_read_failed") for r in rows if r["id"] in failed], "id string, kind string, code string"),
        batches=spark.createDataFrame(list(batches), "ok boolean"),
        warnings=spark.createDataFrame([], "pos long, warning string"),
        source_states=spark.createDataFrame([("s", "c", None, None, DAY)], "source_id string, cursor string, etag string, last_modified string, last_success_at timestamp"),
    )


def state_of(seen, spark):
    if seen is not None:
        return PreviousState(seen.tables["recommended"].drop("version"), seen.tables["source_states"].drop("version"))
    return PreviousState(spark.createDataFrame([], "id string, run long, part long, pos long"), spark.createDataFrame([], "source_id string, cursor string, etag string, last_modified string, last_success_at timestamp"))


def run_of(spark, given, number, seen=None, at=DAY, settings=Settings()):
    return integrate(given, state_of(seen, spark), TAXONOMY, settings, at, number, "model", 0.0)


def publish(run, root, number):
    return publish_run(run, root, number, LIMIT, 1 << 30)


def failing(run):
    return sorted(r["check"] for r in run.gate.where("NOT passed").collect())


def test_items_scores_relations_and_report(spark):
    rows = [candidate(1), candidate(2, degraded=True), candidate(3, degraded=True, summary="latin"), candidate(4, kind="blog")]
    relations = [("paper1", 2, "r", "paper2", 0.9), ("paper1", 1, "r", "t1", 0.4), ("paper1", 0, "r", "old-item", 0.9), ("paper1", 3, "r", "gone", 0.9), ("paper2", 0, "r", "paper1", 1.0), ("other", 0, "r", "t1", 1.0)]
    run = run_of(spark, outputs(spark, rows, relations=relations), 7)
    assert failing(run) == []
    got = {r["id"]: r for r in run.items.collect()}
    assert sorted(got) == ["blog4", "paper1", "paper2"]  # a degraded row that nobody can read is left out
    assert [r["target_id"] for r in got["paper1"]["graph_relations"]] == ["t1", "paper2"] and got["paper2"]["graph_relations"] == []
    assert got["paper1"]["final_score"] == pytest.approx(0.55 * 0.8 + 0.20 / 3 + 0.15 * 0.5 + 0.10 * 4 / 6)
    assert got["blog4"]["final_score"] == pytest.approx(0.55 * 0.8 + 0.15 * 0.5 + 0.10 * 3 / 4)
    assert (got["paper1"]["abstract"], got["blog4"]["abstract"], got["blog4"]["arxiv_id"]) == ("e", None, None)
    assert [r["warning"] for r in run.warnings.collect()] == ["pruned 2 graph relation(s) with unknown target id(s) from paper1 (first: old-item)"]
    assert sorted((r["kind"], r["rank"], r["item_id"]) for r in run.digest.collect()) == [("blog", 1, "blog4"), ("paper", 1, "paper1"), ("paper", 2, "paper2")]
    report = run.report.first()
    assert tuple(report[c] for c in ("run", "paper_candidates", "blog_candidates", "paper_recommendations", "blog_recommendations", "success_rate", "llm_calls", "warnings")) == (7, 2, 1, 2, 1, 1.0, 1, 1)


@pytest.mark.parametrize(
    ("change", "check"),
    [
        (lambda s, g: replace(g, manifests=g.manifests.withColumn("run_id", F.col("stage"))), ["manifests"]),
        (lambda s, g: replace(g, candidates=g.candidates.union(g.candidates.limit(1))), ["duplicate_candidates"]),
        (lambda s, g: replace(g, batches=s.createDataFrame([(False,), (True,)], "ok boolean")), ["metadata_rate"]),
        (lambda s, g: replace(g, readings=g.readings.withColumn("id", F.when(F.col("id") == "paper1", "stray").otherwise(F.col("id")))), ["orphan_readings", "reading_results"]),
        (lambda s, g: replace(g, readings=g.readings.union(g.readings.limit(1))), ["duplicate_readings"]),
        (lambda s, g: replace(g, failures=s.createDataFrame([("paper1", "paper", "x")], g.failures.schema), readings=g.readings.where("id <> 'paper1'")), ["reading_rate"]),
        (lambda s, g: replace(g, candidates=g.candidates.withColumn("methods", F.array(F.lit("nope")))), ["item_contract", "metadata"]),
        (lambda s, g: replace(g, candidates=g.candidates.withColumn("excerpt", F.repeat(F.lit("x"), F.lit(4001)))), ["long_excerpts"]),
        (lambda s, g: replace(g, candidates=g.candidates.withColumn("url", F.lit("ftp://x"))), ["item_contract"]),
        (lambda s, g: replace(g, readings=g.readings.withColumn("paper_reading", F.col("paper_reading").withField("analysis_basis", F.lit("x")))), ["reading_basis"]),
        (lambda s, g: replace(g, candidates=g.candidates.withColumn("summary", F.repeat(F.lit("中"), F.lit(20_000)))), ["item_size"]),
    ],
)
def test_gates(spark, change, check):
    given = outputs(spark, [candidate(k) for k in range(1, 4)] + [candidate(4, kind="blog")])
    run = run_of(spark, change(spark, given), 1)
    assert failing(run) == check
    root = scratch_path(spark, "published")
    with pytest.raises(PublishRefused):
        publish(run, root, 1)
    assert current_run(spark, root) is None


def test_overflow(spark):
    given = outputs(spark, [candidate(k) for k in range(3)])
    assert failing(run_of(spark, given, 1, settings=Settings(deep_reads_per_kind=2))) == ["overflow"]


def test_a_refused_or_broken_run_leaves_the_state_before_it(spark, monkeypatch):
    root = scratch_path(spark, "published")
    first = publish(run_of(spark, outputs(spark, [candidate(1), candidate(2)]), 1), root, 1)
    assert (first.run, sorted(r["id"] for r in first.items.collect())) == (1, ["paper1", "paper2"])

    def seen():
        now = current_run(spark, root)
        return now.run, sorted(r["id"] for r in now.items.collect()), sorted(r["item_id"] for r in now.tables["digest"].collect())

    refused = outputs(spark, [candidate(8)], batches=((False,),))
    with pytest.raises(PublishRefused, match="metadata_rate"):
        publish(run_of(spark, refused, 2, first), root, 2)
    assert seen() == (1, ["paper1", "paper2"], ["paper1", "paper2"])

    import digestry.sources.publish as module

    broken = run_of(spark, outputs(spark, [candidate(3)]), 2, first, DAY + timedelta(days=1))
    with monkeypatch.context() as patch:
        patch.setattr(module, "stored_bytes", lambda *_: 1 / 0)  # after items and tables, before the state
        with pytest.raises(ZeroDivisionError):
            publish(broken, root, 2)
    assert seen() == (1, ["paper1", "paper2"], ["paper1", "paper2"])
    again = publish(run_of(spark, outputs(spark, [candidate(4)]), 2, first, DAY + timedelta(days=1)), root, 2)
    assert seen() == (2, ["paper1", "paper2", "paper4"], ["paper1", "paper2", "paper4"])  # nothing of the broken one
    assert [r["id"] for r in again.tables["recommended"].orderBy("run", "part", "pos").collect()] == ["paper1", "paper2", "paper4"]
    with pytest.raises(PublishRefused, match="not newer"):
        publish(broken, root, 2)


def test_a_later_run_of_a_day_replaces_its_digest(spark):
    root = scratch_path(spark, "published")
    first = publish(run_of(spark, outputs(spark, [candidate(1)]), 1), root, 1)
    second = publish(run_of(spark, outputs(spark, [candidate(2)]), 2, first), root, 2)
    assert [r["item_id"] for r in second.tables["digest"].collect()] == ["paper2"]
    assert sorted(r["id"] for r in second.tables["recommended"].collect()) == ["paper1", "paper2"]
    assert second.tables["report"].count() == 2


def test_digests_must_find_their_items(spark):
    root = scratch_path(spark, "published")
    run = run_of(spark, outputs(spark, [candidate(1)]), 1)
    with pytest.raises(PublishRefused, match="missing item: elsewhere"):
        publish(replace(run, digest=run.digest.withColumn("item_id", F.lit("elsewhere"))), root, 1)
    assert current_run(spark, root) is None
