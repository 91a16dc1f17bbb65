"""Windows, deduplication, term matching, prefilter and shortlist on small frames."""

from __future__ import annotations

import random
import re
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from digestry.config import Label, MetadataWeights, Settings, Taxonomy, check_taxonomy, check_weights
from digestry.operators import collect, history, prefilter, scoring, terms
from digestry.operators.select_best import best_per_key

TAXONOMY = Taxonomy(
    (
        Label("targets", "content", "内容", "Content", ("item recommendation", "recommender")),
        Label("scenarios", "feed", "文字", "Feed", ("news feed",)),
        Label("tasks", "ranking", "排序", "Ranking", ("re-ranking", "ranking")),
        Label("methods", "gnn", "图", "GNN", ("GNN", "c++")),
    ),
    ("recommender", "news feed"),
)
COLUMNS = (
    "row_key bigint, kind string, source_id string, id string, title string, url string, published_at timestamp, "
    "excerpt string, categories array<string>, source_weight double"
)


def candidate(key, kind="paper", title=None, excerpt="a recommender", at=None, weight=1.0, source="s", id=None):
    at = at or datetime(2026, 8, 1, tzinfo=timezone.utc)
    return (key, kind, source, id or f"id-{key:04d}", title or f"title {key}", None, at, excerpt, ["cs.IR"], weight)


def frame(spark, rows, partitions=3):
    return spark.createDataFrame(rows, COLUMNS).repartition(partitions)


def no_history(spark):
    return spark.createDataFrame([], "id string")


def brute(text, vocabulary):
    return {t for t in vocabulary if re.search(r"(?<!\w)" + re.escape(t) + r"(?!\w)", text)}


def test_both_matchers_agree_with_a_plain_search(spark):
    rng = random.Random(5)
    vocabulary = ["of the", "tion", "thing", "two-tower model", "c++", "über", "a", "#1", "x_y", "of"]
    pieces = ["of", "the", "of the", "nation", "tion", "thing", "things", "two-tower model", "two tower model", "c++", "c+++", "über", "überall", "a", "#1", "x_y", ",", "-", "_of"]
    texts = [(i, rng.choice([" ", "", ", "]).join(rng.choices(pieces, k=rng.randint(0, 14)))) for i in range(400)]
    data = spark.createDataFrame(texts, "id bigint, text_norm string")
    want = {(i, t) for i, text in texts for t in brute(text, vocabulary)}
    inline = data.select("id", F.explode(terms.term_hits(F.col("text_norm"), vocabulary)).alias("term"))
    joined = terms.match_terms(data, spark.createDataFrame([(t,) for t in vocabulary], "term string"))
    assert {tuple(r) for r in inline.collect()} == want
    rows = [tuple(r) for r in joined.collect()]
    assert set(rows) == want and len(rows) == len(want)


def test_terms_gathered_by_text_are_those_of_the_rows_and_move_once(spark):
    texts = [(1, "the c++ of the c++ thing"), (1, "the end"), (2, "nothing"), (3, "of the, the"), (4, "")]
    data = spark.createDataFrame(texts, "id bigint, text_norm string").repartition(3)
    vocabulary = spark.createDataFrame([(t,) for t in ("the", "of the", "c++", "thing", "the,", "end")], "term string")
    gathered = terms.matched_terms(data, vocabulary)
    assert {r["id"]: r["terms"] for r in gathered.collect()} == {1: ["c++", "end", "of the", "the", "thing"], 3: ["of the", "the", "the,"]}
    rows = terms.match_terms(data, vocabulary).groupBy("id").agg(F.sort_array(F.collect_list("term")).alias("terms"))
    assert sorted(map(tuple, gathered.collect())) == sorted(map(tuple, rows.collect()))
    text_ready = spark.createDataFrame(texts, "id bigint, text_norm string")
    plan = terms.matched_terms(text_ready, vocabulary)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_collect_set" in plan


def test_token_pattern_cuts_as_the_plain_one(spark):
    rng = random.Random(11)
    signs = list(" abz_09,.-+'\n\t") + ["\u00e9", "\u00df", "\u0301", "\u200d", "\u203f", "\u00a0", "\u4e2d", "\u0660", "\U0001d400", "\U0001f600", "A"]
    data = spark.createDataFrame([("".join(rng.choices(signs, k=rng.randint(0, 40))),) for _ in range(2000)], "t string")
    plain = F.regexp_extract_all("t", F.lit(r"(?U)\w+|\W"), F.lit(0))
    assert data.where(~terms.tokens(F.col("t")).eqNullSafe(plain)).count() == 0


def test_repeated_terms_count_twice(spark):
    hits = F.array(F.lit("a"), F.lit("b"))
    row = spark.range(1).select(
        terms.term_coverage(hits, ["a", "A ", "c", "d"]).alias("twice"), terms.term_coverage(hits, []).alias("none")
    ).first()
    assert (row["twice"], row["none"]) == (0.5, 0.0)


def test_vocabularies_of_hundreds_of_terms(spark):
    data = spark.createDataFrame([("t7 and t299 but not t300x",)], "text_norm string")
    got = data.select(terms.term_hits(F.col("text_norm"), [f"t{i}" for i in range(301)]).alias("h")).first()["h"]
    assert sorted(got) == ["t299", "t7"]


def test_window_is_inclusive_on_both_ends(spark):
    now = datetime(2026, 8, 15, tzinfo=timezone.utc)
    last = datetime(2026, 8, 14, tzinfo=timezone.utc)
    second = timedelta(seconds=1)
    moments = [
        ("paper", last - timedelta(hours=48), True), ("paper", last - timedelta(hours=48) - second, False),
        ("blog", last - timedelta(days=7), True), ("blog", last - timedelta(days=7) - second, False),
        ("paper", now, True), ("paper", now + second, False),
    ]
    data = spark.createDataFrame([(i, k, t) for i, (k, t, _) in enumerate(moments)], "i int, kind string, at timestamp")
    kept = data.where(collect.in_window(F.col("at"), F.col("kind"), now, last)).select("i").collect()
    assert {r[0] for r in kept} == {i for i, (_, _, ok) in enumerate(moments) if ok}


def test_state_without_last_success_is_reported(spark):
    states = spark.createDataFrame([("a", None), ("b", datetime(2026, 1, 1))], "s string, last_success_at timestamp")
    assert [r["s"] for r in collect.check_state(states).collect()] == ["a"]


def test_collection_keeps_the_heaviest_then_newest_copy(spark):
    day = datetime(2026, 8, 1, tzinfo=timezone.utc)
    rows = [
        candidate(1, id="x", weight=0.9, at=day + timedelta(days=9)), candidate(2, id="x", weight=1.0, at=day),
        candidate(3, id="x", weight=1.0, at=day + timedelta(days=1), source="b"),
        candidate(4, id="x", weight=1.0, at=day + timedelta(days=1), source="a"),
    ]
    assert [r["row_key"] for r in collect.dedupe_collected(frame(spark, rows)).collect()] == [4]


def test_prefilter_caps_and_ignores_input_order(spark, now):
    rows = [candidate(i) for i in range(102)] + [candidate(1000 + i, "blog") for i in range(52)]
    seen = spark.createDataFrame([("id-0000",)], "id string")
    results = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        got = prefilter.prefilter(frame(spark, rows, seed + 2), seen, TAXONOMY, Settings(), now)
        results.append(sorted((r["kind"], r["kind_rank"], r["id"]) for r in got.collect()))
    assert results[0] == results[1]
    assert len(results[0]) == 150 and ("paper", 1, "id-0001") in results[0]
    assert not any(row[2] == "id-0000" for row in results[0])


def test_gate_needs_a_configured_term(spark, now):
    rows = [candidate(1, excerpt="generic text"), candidate(2, excerpt="A News\nFeed!"), candidate(3, excerpt="recommenders")]
    got = prefilter.prefilter(frame(spark, rows), no_history(spark), TAXONOMY, Settings(), now)
    assert [r["row_key"] for r in got.collect()] == [2]


def test_gate_comes_after_deduplication(spark, now):
    """The heavier copy wins even if only the lighter one has evidence."""
    rows = [candidate(1, id="x", weight=1.0, excerpt="nothing"), candidate(2, id="x", weight=0.5)]
    assert prefilter.prefilter(frame(spark, rows), no_history(spark), TAXONOMY, Settings(), now).count() == 0


def test_score_of_one_row(spark, now):
    row = candidate(1, excerpt="recommender ranking, news feed", at=now - timedelta(days=365), weight=0.5)
    got = prefilter.annotate(frame(spark, [row]), TAXONOMY, Settings(), now).first()
    topic, scenario = 2 / 6, 1.0
    want = 0.30 * topic + 0.25 * scenario + 0.15 * 0.5 + 0.15 + 0.10 * (topic + scenario) / 2 + 0.05 * (1 - 365 / 1825)
    assert got["metadata_score"] == pytest.approx(want, abs=1e-12)
    assert (got["targets"], got["scenarios"], got["tasks"], got["methods"]) == (["content"], ["feed"], ["ranking"], [])


def test_novelty_is_zero_for_history_rows(spark, now):
    data = frame(spark, [candidate(1)])
    score = scoring.metadata_score(
        F.lit("paper"), F.array().cast("array<string>"), F.lit(1.0), F.col("published_at"), now, TAXONOMY,
        MetadataWeights(0, 0, 0, 1, 0, 0), 1.0, F.col("row_key") == 1,
    )
    assert data.select(score.alias("s")).first()["s"] == 0.0


def test_large_limits_prune_before_the_shuffle(spark):
    data = spark.range(5000).repartition(7).withColumn("k", F.concat(F.lit("hot"), F.col("id") % 1))
    got = best_per_key(data, ["k"], [F.col("id")], 1500)
    assert got._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2
    got = got.collect()
    assert sorted((r["id"], r["rank"]) for r in got) == [(i, i + 1) for i in range(1500)]


def test_a_hot_id_leaves_each_partition_as_one_row(spark):
    """A third of all rows under one id: the plan prunes before the shuffle."""
    data = spark.range(9000).select(
        F.col("id").alias("row_key"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"),
        F.lit(1.0).alias("source_weight"), F.current_timestamp().alias("published_at"), F.lit("s").alias("source_id"),
    )
    best = collect.dedupe_collected(data)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert best.count() == 6001


def test_source_weights_come_from_the_list(spark):
    from digestry.config import Source, source_frame

    sources = source_frame(spark, [Source("s", "paper", 0.7, scenarios=("feed",)), Source("off", "paper", 0.1, enabled=False)])
    rows = frame(spark, [candidate(1), candidate(2, source="off")]).drop("source_weight")
    got = {r["row_key"]: (r["source_weight"], r["source_scenarios"]) for r in collect.attach_sources(rows, sources, 0.9).collect()}
    assert got == {1: (0.7, ["feed"]), 2: (0.9, [])}


def test_shortlist_needs_relevance_and_a_label(spark):
    rows = [
        ("a", "paper", 0.65, ["x"]), ("b", "paper", 0.649, ["x"]), ("c", "paper", 0.9, []), ("d", "paper", 0.9, ["x"]),
        ("e", "blog", 0.7, ["x"]),
    ]
    at = datetime(2026, 1, 1)
    empty = []
    data = spark.createDataFrame(
        [(i, k, r, t, empty, empty, empty, at, "s") for i, k, r, t in rows],
        "id string, kind string, relevance_score double, targets array<string>, scenarios array<string>, tasks array<string>, "
        "methods array<string>, published_at timestamp, source_id string",
    )
    got = prefilter.shortlist(data, 0.65, 20).collect()
    assert sorted((r["id"], r["shortlist_rank"]) for r in got) == [("a", 2), ("d", 1), ("e", 1)]


def test_recommended_ids_keep_their_order(spark):
    old = spark.createDataFrame([("a", 0, 0, 1), ("b", 0, 0, 2)], "id string, run bigint, part bigint, pos bigint")
    new = spark.createDataFrame([("d", "blog", 1), ("b", "paper", 1), ("c", "paper", 2)], "item_id string, kind string, rank int")
    got = history.merge_recommended(old, new, 1).orderBy("run", "part", "pos").collect()
    assert [r["id"] for r in got] == ["a", "b", "c", "d"]


def test_source_states_merge_by_source(spark):
    schema = "source_id string, cursor string, etag string, last_modified string, last_success_at timestamp"
    old = spark.createDataFrame([("a", "c1", "e1", "m1", datetime(2026, 1, 1)), ("b", None, "e2", None, None)], schema)
    new = spark.createDataFrame([("a", None, "e9", None, datetime(2026, 2, 1)), ("n", None, None, None, None)], schema)
    got = {r["source_id"]: tuple(r)[1:4] for r in history.merge_source_states(old, new).collect()}
    assert got == {"a": ("c1", "e9", "m1"), "b": (None, "e2", None), "n": (None, None, None)}


def test_configuration_is_checked():
    with pytest.raises(ValueError):
        check_weights(MetadataWeights(topic=0.4))
    with pytest.raises(ValueError):
        check_taxonomy(Taxonomy((Label("tasks", "x", "x", "x", ()), Label("methods", "x", "x", "x", ()))))
