"""Responses, batches, readings, ranking and gates on small frames."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from digestry.config import FinalWeights, Label, Taxonomy
from digestry.operators import items, metadata, quality, ranking, readings, reports, scoring
from digestry.operators.scoring import final_score

TAXONOMY = Taxonomy(
    (
        Label("targets", "content", "内容", "Content", ("content",)),
        Label("scenarios", "feed", "文字", "Feed", ("feed",)),
        Label("tasks", "ranking", "排序", "Ranking", ("ranking",)),
        Label("methods", "gnn", "图", "GNN", ("gnn",)),
    )
)
KNOWN = [label.id for label in TAXONOMY.labels]


def test_responses_are_unfenced_and_strict(spark):
    rows = [
        (1, '```json\n{"id": "a", "relevance": 0.5}\n```'), (2, '{"id": "a"'), (3, '[{"id": "a"}]'),
        (4, '{"id": "a", "prompt": "x"}'), (5, '```\n{"id": "a"}'), (6, '  {"id": "b"}\n'), (7, None),
    ]
    data = spark.createDataFrame(rows, "k int, output_text string")
    got = {r["k"]: (r["reason"], r["r"]["id"] if r["r"] else None) for r in metadata.parse_responses(data, "id string, relevance double", ["id", "relevance"], "k").collect()}
    assert got == {
        1: (None, "a"), 2: ("not_json", None), 3: ("not_object", None), 4: ("unknown_field", None),
        5: ("not_json", None), 6: (None, "b"), 7: ("not_json", None),
    }


def batch_frames(spark, answers, n=16):
    requested = spark.createDataFrame(
        [(f"i{k:02d}", "title", " e 中", 0.9 - k / 100, ["content"], [], [], [], k) for k in range(n)],
        "id string, title string, excerpt string, metadata_score double, targets array<string>, scenarios array<string>, tasks array<string>, methods array<string>, row_key bigint",
    )
    requested = metadata.assign_batches(requested, [F.col("id")], 8)
    returned = spark.createDataFrame(answers, "batch bigint, id string, summary string, proposed array<string>, relevance double")
    return requested, returned


def good(n=16):
    return [(k // 8, f"i{k:02d}", "好", ["content", "gnn"], 0.7) for k in range(n)]


@pytest.mark.parametrize(
    "break_it",
    [
        lambda rows: rows[:-1], lambda rows: rows + [rows[-1]], lambda rows: rows + [(1, "stray", "好", ["gnn"], 0.1)],
        lambda rows: rows[:-1] + [(1, "i15", "latin", ["gnn"], 0.1)], lambda rows: rows[:-1] + [(1, "i15", "好", ["nope"], 0.1)],
        lambda rows: rows[:-1] + [(1, "i15", "好", ["gnn"], 1.1)], lambda rows: rows[:-1] + [(1, "i15", "好", ["gnn"], None)],
    ],
)
def test_one_bad_row_degrades_its_whole_batch(spark, break_it):
    requested, returned = batch_frames(spark, break_it(good()))
    batches = metadata.validate_batches(requested, returned, ["batch"], KNOWN)
    assert {r["batch"]: r["ok"] for r in batches.collect()} == {0: True, 1: False}
    rows = metadata.resolve(requested, returned, batches, ["batch"], 4000).collect()
    assert len(rows) == 16
    for row in rows:
        if row["batch"] == 0:
            assert (row["degraded"], row["summary"], row["targets"], row["methods"], row["label_rejections"]) == (False, "好", ["content"], [], 1)
        else:
            assert (row["degraded"], row["summary"], row["targets"], row["relevance_score"]) == (True, "e 中", ["content"], row["metadata_score"])


def test_rule_summary_needs_the_script(spark):
    got = spark.createDataFrame([(1, " 中文摘要 "), (2, "latin")], "k int, e string").orderBy("k").select(metadata.rule_summary(F.col("e"), 3)).collect()
    assert [r[0] for r in got] == ["中文摘", None]


def test_degraded_rows_need_summary_and_all_groups(spark):
    full, rows = ["x"], []
    for k, (degraded, summary, methods) in enumerate([(False, None, []), (True, "中", full), (True, "latin", full), (True, "中", []), (True, None, full)]):
        rows.append((k, degraded, summary, full, full, full, methods))
    data = spark.createDataFrame(rows, "k int, degraded boolean, summary string, targets array<string>, scenarios array<string>, tasks array<string>, methods array<string>")
    assert sorted(r["k"] for r in data.where(metadata.publishable()).collect()) == [0, 1]


PAPER = (
    "problem_zh string, contributions_zh array<string>, method_zh string, experiments struct<datasets:array<string>,baselines:array<string>,"
    "metrics:array<string>,findings_zh:array<string>>, limitations_zh array<string>, evidence_refs array<struct<section:string,page:int>>"
)


def test_paper_quality_rules(spark):
    none = ([], [], [], [])
    rows = [
        (" ", ["c"], "m", none, ["l"], []), ("p", [" "], None, none, ["l"], []), ("p", [], "m", none, [" "], []),
        ("p", [], "m", none, [], [("s", 1)]), ("p", ["c"], None, ([], [], ["auc"], []), [], []),
    ]
    data = spark.createDataFrame(list(enumerate(rows)), f"k int, r struct<{PAPER.replace(' string', ':string').replace(' array', ':array').replace(' struct', ':struct')}>")
    got = [r[0] for r in data.orderBy("k").select(readings.paper_reason(F.col("r"))).collect()]
    assert got == ["no_problem", "no_method", "no_evidence", None, None]
    parts = [r[0] for r in data.orderBy("k").select(scoring.paper_depth_parts(F.col("r"))).collect()]
    assert parts == [3, 2, 2, 2, 3]


def test_context_fits_or_fails_whole(spark):
    rows = [("a", 2, "y" * 8), ("a", 1, "x" * 4), ("b", 1, "z" * 400)]
    data = spark.createDataFrame(rows, "g string, p int, t string")
    got = {r["g"]: (r["tokens"], r["fits"], r["context"]) for r in readings.context_budget(data, "g", "p", "t", 3).collect()}
    assert got == {"a": (3, True, "xxxx\n\nyyyyyyyy"), "b": (100, False, None)}
    with pytest.raises(ValueError):
        readings.context_budget(data, "g", "p", "t", 0)


def test_transient_fields_are_dropped(spark):
    data = spark.createDataFrame([("a", "raw", "bad")], "id string, raw_text string, analysis_basis string")
    row = readings.drop_transient(data, F.lit("article_html")).first()
    assert row.asDict() == {"id": "a", "analysis_basis": "article_html"}


def test_empty_kind_and_exact_minimum_pass(spark):
    rates = spark.createDataFrame([("paper", 4, 5), ("blog", 0, 0), ("metadata", 79, 100)], "name string, succeeded bigint, attempted bigint")
    gated = reports.success_gate(rates, 0.80)
    assert {r["name"]: (r["rate"], r["passed"]) for r in gated.collect()} == {"paper": (0.8, True), "blog": (1.0, True), "metadata": (0.79, False)}
    assert tuple(reports.run_rate(gated).first()) == (0.79, False)


def ranked_rows(spark):
    day = datetime(2026, 8, 1, tzinfo=timezone.utc)
    rows = [("a", "paper", 0.9, 0.1), ("b", "paper", 0.2, 1.0), ("c", "paper", 0.2, 1.0), ("d", "paper", 0.9, 0.4), ("e", "blog", 0.5, 0.5)]
    return spark.createDataFrame([(i, k, r, e, day, "s") for i, k, r, e in rows], "id string, kind string, relevance double, evidence double, published_at timestamp, source string")


def test_ranking_filters_before_it_limits(spark):
    weights = FinalWeights(0, 1, 0, 0)
    scored = ranked_rows(spark).withColumn("final_score", final_score(F.col("relevance"), F.col("evidence"), F.lit(0.0), F.lit(0.0), weights))
    got = ranking.rank_items(scored, 10, 0.5).collect()
    assert sorted((r["kind"], r["rank"], r["id"]) for r in got) == [("blog", 1, "e"), ("paper", 1, "b"), ("paper", 2, "c")]
    plain = ranked_rows(spark).withColumn("final_score", final_score(F.col("relevance"), None, None, None, None))
    assert [r["id"] for r in ranking.rank_items(plain.where("kind = 'paper'"), 2).orderBy("rank").collect()] == ["a", "d"]
    with pytest.raises(ValueError):
        ranking.rank_items(plain, 10, 1.5)


def test_final_score_of_the_published_example(spark):
    row = spark.range(1).select(final_score(F.lit(0.80), F.lit(0.55), F.lit(0.70), F.lit(0.85), FinalWeights()).alias("s")).first()
    assert row["s"] == pytest.approx(0.74)


def test_relations_are_pruned_with_a_warning(spark):
    relations = spark.createDataFrame([("a", 2, "missing-2"), ("a", 1, "missing-1"), ("a", 3, "b"), ("b", 4, "ranking")], "id string, pos bigint, target_id string")
    run = spark.createDataFrame([("a",), ("b",)], "id string")
    marked = items.mark_relations(relations, items.allowed_targets(run, TAXONOMY.frame(spark)))
    assert sorted((r["id"], r["pos"]) for r in marked.where("kept").collect()) == [("a", 3), ("b", 4)]
    assert [tuple(r) for r in items.pruning_warnings(marked).collect()] == [("a", 2, "missing-1")]


def test_reconcile_reports_both_sides(spark):
    def rows(*pairs):
        return spark.createDataFrame(list(pairs), "kind string, id string")

    report = readings.reconcile(rows(("paper", "a"), ("paper", "b"), ("blog", "z")), rows(("paper", "a"), ("paper", "x")), rows(("paper", "a")))
    got = {r["kind"]: r for r in report.collect()}
    assert (got["paper"]["missing"], got["paper"]["unexpected"], got["paper"]["duplicated"], got["paper"]["first_missing"], got["paper"]["first_unexpected"]) == (1, 1, 1, "b", "x")
    assert (got["blog"]["missing"], got["blog"]["success_rate"]) == (1, 1.0)


def test_gates(spark):
    manifests = spark.createDataFrame([("r1", "1"), ("r1", "1"), ("r2", "1")], "run_id string, schema_version string")
    assert [r[0] for r in quality.manifest_violations(manifests).collect()] == ["run_id"]
    files = spark.createDataFrame([("a/x.json",), ("a/x.HTML",), ("a/y.pdf",)], "path string")
    assert quality.forbidden_files(files).count() == 2 and quality.unsupported_files(files).count() == 2
    many = spark.range(21).select(F.lit("paper").alias("kind"))
    assert [tuple(r) for r in quality.overflow(many, 20).collect()] == [("paper", 21)]


def test_digest_contract(spark):
    day = datetime(2026, 8, 1).date()
    entries = spark.createDataFrame([(day, "paper", "a", 1), (day, "paper", "a", 2), (day, "blog", "a", 1), (day, "paper", "none", 0)], "digest_date date, kind string, item_id string, rank int")
    known = spark.createDataFrame([("a", "paper")], "id string, kind string")
    got = sorted((r["kind"], r["item_id"], r["rule"]) for r in ranking.digest_violations(entries, known).collect())
    assert got == [("blog", "a", "wrong_kind"), ("paper", "a", "duplicate_item"), ("paper", "none", "bad_rank"), ("paper", "none", "unknown_item")]


def test_second_feed_lookup_order(spark):
    blogs = spark.createDataFrame([(1, "s", "i1", "u1", "t1"), (2, "s", "i2", "u2", "t2"), (3, "s", "i3", None, "t3"), (4, "o", "i1", "u1", "t1")], "k int, source_id string, id string, url_norm string, title_norm string")
    feed = spark.createDataFrame(
        [("s", "i1", "u9", "t9", "old", 1), ("s", "i1", "u8", "t8", " new ", 2), ("s", "x", "u2", "t7", "by url", 3), ("s", "y", "u6", "t3", "by title", 4), ("s", "i3", "u", "t", "  ", 5)],
        "source_id string, id string, url_norm string, title_norm string, body string, feed_order int",
    )
    got = {r["k"]: (r["matched_by"], r["body"]) for r in readings.second_source_content(blogs, feed).collect()}
    assert got == {1: ("id", "new"), 2: ("url", "by url"), 3: ("title", "by title"), 4: (None, None)}
