"""Graph questions and related items against brute force."""

from __future__ import annotations

import random
import unicodedata
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from digestry.config import GROUPS, Label, Taxonomy
from digestry.operators import graph, related, search

NODE = "id string, label string, type string, published_at timestamp, tags array<string>, search_terms array<string>, weight int, node_ord int"
EDGE = "id string, source string, target string, type string, confidence double, evidence string, generated_by string"


def moment(text):
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


WORDS = ("tide", "lamp", "ｒｏｐｅ", "灯塔", "Knot", "gull")
TODAY = moment("2026-08-15")


@pytest.fixture(scope="module")
def coast(spark):
    """Twenty logs and six labels with random edges; one label and some logs stay alone. Also as plain rows for brute force."""
    rng = random.Random(41)
    labels = [f"{kind}:{name}" for kind, name in (("target", "pier"), ("target", "cove"), ("task", "mend"), ("task", "sail"), ("method", "chart"), ("method", "lost"))]
    nodes, edges = [], []
    for k in range(20):
        tags = rng.sample([x.split(":")[1] for x in labels[:-1]], rng.randint(0, 3))
        title = " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 3)))
        at = TODAY - timedelta(days=rng.choice([0, 7, 8, 29, 31, 364, 400, 900])) if k % 7 else None
        nodes.append((f"log-{k}", title, rng.choice(["paper", "article"]), at, tags, [f"log {k}", rng.choice(WORDS)], 1 + k % 3))
        edges += [(f"taxonomy:log-{k}|{x}", f"log-{k}", x, x.split(":")[0]) for x in labels if x.split(":")[1] in tags]
    nodes += [(x, f"{x.split(':')[1]} / {rng.choice(WORDS)}", x.split(":")[0], None, None, [x.split(":")[1]], 1) for x in labels]
    links = {tuple(rng.sample(range(20), 2)) for _ in range(12)}
    edges += [(f"relation:log-{i}|log-{j}|near", f"log-{i}", f"log-{j}", "near") for i, j in sorted(links)]
    node_frame = spark.createDataFrame([(*row, place) for place, row in enumerate(nodes)], NODE)
    return node_frame, spark.createDataFrame([(*e, 1.0, "seen", "model") for e in edges], EDGE), nodes, edges


def is_log(name):
    return name.startswith("log-")


def plain_neighbors(edges, name):
    return {t for _, s, t, _ in edges if s == name} | {s for _, s, t, _ in edges if t == name}


def within(edges, names):
    return {i for i, s, t, _ in edges if s in names and t in names}


def ids(frame):
    return {r["id"] for r in frame.collect()}


def test_adjacency_includes_isolated_nodes(coast):
    near = {r["id"]: r["neighbors"] for r in graph.adjacency(*coast[:2]).collect()}
    assert near == {n[0]: sorted(plain_neighbors(coast[3], n[0])) for n in coast[2]} and near["method:lost"] == []


@pytest.mark.parametrize(
    ("groups", "year", "age", "days"),
    [({"targets": ["pier", "cove"], "tasks": ["mend"]}, None, None, None), ({"methods": ["chart"], "tasks": []}, "2026", None, None), ({}, None, "7d", 7), ({}, "2025", "365d", 365), ({"targets": ["cove"]}, None, "30d", 30)],
)
def test_subgraphs(coast, groups, year, age, days):
    nodes, edges, plain, links = coast

    def fits(node):
        _, _, _, at, tags, *_ = node
        timed = (not year and not days) or (at is not None and (not year or at.year == int(year)) and (not days or TODAY - at <= timedelta(days=days)))
        return is_log(node[0]) and timed and all(not v or set(v) & set(tags) for v in groups.values())

    logs = {n[0] for n in plain if fits(n)}
    want = logs | {x for name in logs for x in plain_neighbors(links, name) if not is_log(x)}
    kept, between = graph.subgraph(nodes, edges, graph.content_matching(nodes, groups, year, age, TODAY))
    assert ids(kept) == want and ids(between) == within(links, want)
    assert logs


@pytest.mark.parametrize("types", [["article", "task"], ["paper", "method"], ["target"], []])
def test_type_toggles(coast, types):
    nodes, edges, plain, links = coast
    chosen = {n[0] for n in plain if n[2] in types}
    inside = within(links, chosen)
    ends = {x for i, s, t, _ in links if i in inside for x in (s, t)}
    kept, between = graph.filter_types(nodes, edges, types)
    assert ids(between) == inside and ids(kept) == {name for name in chosen if is_log(name) or name in ends}


def test_neighborhoods_of_many_centres(spark, coast):
    nodes, edges, plain, links = coast
    wanted = ["log-1", "log-4", "target:pier", "method:lost", "nowhere"]
    near, inner = graph.neighborhoods(nodes, edges, spark.createDataFrame([(c,) for c in wanted], "center string"))
    want = {c: {c} | plain_neighbors(links, c) for c in wanted[:-1]}
    got = {}
    for row in near.collect():
        got.setdefault(row["center"], set()).add(row["id"])
    assert got == want
    assert {(r["center"], r["id"]) for r in inner.collect()} == {(c, i) for c, names in want.items() for i in within(links, names)}
    assert ids(graph.content_centers(nodes).withColumnRenamed("center", "id")) == {n[0] for n in plain if is_log(n[0])}


@pytest.mark.parametrize("query", ["  TIDE   ", "rope", "灯塔 lamp", "pier", "log 7", "Ｋnot gull", "absent", "  "])
def test_search_buckets_and_order(coast, query):
    def form(text):
        return " ".join(unicodedata.normalize("NFKC", text).lower().split())

    wanted, scored = form(query), []
    for place, (name, label, _, _, tags, terms, _) in enumerate(coast[2]):
        hay = form(" ".join([name, label, *(terms or tags)]))
        if wanted and all(term in hay for term in wanted.split(" ")):
            exact = wanted in (form(name), form(label), *map(form, terms or tags))
            prefix = form(name).startswith(wanted) or form(label).startswith(wanted)
            scored.append((-3 if exact else -2 if prefix else -1, place, name))
    assert [r["id"] for r in graph.search_nodes(coast[0], query).collect()] == [name for *_, name in sorted(scored)]


def test_invariants(coast):
    got = {(r["id"], r["rule"]) for r in graph.violations(*coast[:2], 19).collect()}
    assert got == {("method:lost", "isolated_label"), ("20", "too_many_nodes")}


TAXONOMY = Taxonomy((Label("targets", "user", "用户", "User", ()), Label("tasks", "ranking", "排序", "Ranking", ())))
ITEM = (
    "id string, kind string, title string, summary string, published_at timestamp, relevance_score double, final_score double, digest_date date, "
    "targets array<string>, scenarios array<string>, tasks array<string>, methods array<string>"
)


def item(name, labels=(), at="2026-08-14", relevance=0.5, score=0.5, tasks=()):
    return (name, "paper", f"Title {name}", "摘要", moment(at), relevance, score, moment(at).date(), list(labels), [], list(tasks), [])


def test_build_graph(spark, now):
    rows = [item("a", ["user"]), item("b", [], tasks=["ranking"]), item("old", ["user"], at="2020-01-01", relevance=1.0)]
    items = spark.createDataFrame(rows, ITEM)
    relations = spark.createDataFrame(
        [("a", 1, "cites", "b", 0.5, "first", "m"), ("a", 2, "cites", "b", 0.9, "second", "m"), ("a", 3, "cites", "a", 0.9, "self", "m"),
         ("a", 4, "cites", "c", 0.9, "unknown", "m"), ("a", 5, "uses", "ranking", 0.49, "weak", "m"), ("b", 6, "uses", "user", 0.6, "label", "m")],
        "id string, pos bigint, type string, target_id string, confidence double, evidence string, generated_by string",
    )
    counts = relations.groupBy("id").agg(F.count("*").alias("relations"))
    shown = graph.visible_items(items, counts, now, 90, 2)
    assert ids(shown) == {"a", "b"}
    nodes, edges = graph.build_graph(shown, relations, TAXONOMY)
    got = {r["id"]: r for r in edges.collect()}
    assert set(got) == {"taxonomy:a|target:user", "taxonomy:b|task:ranking", "relation:a|b|cites", "relation:b|target:user|uses"}
    assert got["relation:a|b|cites"]["evidence"] == "first"
    weights = {r["id"]: r["weight"] for r in nodes.collect()}
    assert weights == {"a": 2, "b": 3, "target:user": 2, "task:ranking": 1}


def brute_related(rows, limit):
    out = {}
    for a in rows:
        scored = []
        for b in rows:
            shared = len(set(a["labels"]) & set(b["labels"]))
            if b["id"] != a["id"] and shared:
                scored.append((-shared, -b["score"], -b["at"].timestamp(), b["id"]))
        out[a["id"]] = [(c[3], -c[0]) for c in sorted(scored)[:limit]]
    return out


@pytest.mark.parametrize("max_listed", [0, 1, 2, 10])
def test_related_items_are_exact(spark, max_listed):
    """One label set holds a third of the items; every way of matching label sets gives the same answer."""
    rng = random.Random(max_listed)
    names = [f"l{i}" for i in range(6)]
    rows = []
    for k in range(120):
        labels = ["l0", "l1"] if k % 3 == 0 else rng.sample(names, rng.randint(0, 4))
        rows.append({"id": f"i{k:03d}", "labels": sorted(labels), "score": rng.choice([0.1, 0.5, 0.9]), "at": moment("2026-01-01") + timedelta(days=rng.randint(0, 5))})
    data = spark.createDataFrame(
        [(r["id"], r["score"], r["at"], [x for x in r["labels"] if x < "l3"], [x for x in r["labels"] if x >= "l3"]) for r in rows],
        "id string, final_score double, published_at timestamp, targets array<string>, tasks array<string>",
    ).withColumns({g: F.array().cast("array<string>") for g in GROUPS if g not in ("targets", "tasks")})
    got = {r["id"]: [] for r in rows}
    for row in related.related_items(data, 4, max_listed).orderBy("id", "rank").collect():
        got[row["id"]].append((row["related_id"], row["shared"]))
    assert got == brute_related(rows, 4)


DOCUMENT = ("a", "paper", "Lanterns on a Quiet Coast", "海边灯火的记录。", moment("2025-03-02"), 0.5, 0.5, moment("2025-03-09").date(), ["pier"], [], [], ["chart"])


@pytest.mark.parametrize(
    "query, hit",
    [("QUIET 灯火", True), ("quiet 博客", False), ("   ", True), ("论文 2025-03-09 2025-03-02", True), ("工程博客", False), ("chart 码头", True), ("long pier", True), ("海图", True), ("  灯火   ＰＩＥＲ  ", True)],
)
def test_archive_search(spark, query, hit):
    taxonomy = Taxonomy((Label("targets", "pier", "码头", "Long Pier", ()), Label("methods", "chart", "海图", "Sea Chart", ())))
    rows = spark.createDataFrame([DOCUMENT], ITEM)
    assert bool(search.archive_filter(rows, taxonomy, query, {}).count()) is hit


def test_facets(spark, now):
    rows = spark.createDataFrame([item("a", ["user"]), item("b", ["user"], at="2025-01-01"), item("c", [], tasks=["ranking"])], ITEM)
    assert ids(rows.where(search.matches_facets({"targets": ["user", "x"], "year": ["2026"]}, now))) == {"a"}
    assert ids(rows.where(search.matches_facets({"kind": [], "age": ["7d"]}, now))) == {"a", "c"}
    options = spark.createDataFrame([("targets", "user"), ("targets", "room"), ("year", "2026")], "grp string, value string")
    counts = {(r["grp"], r["value"]): r["n"] for r in search.facet_counts(rows, options, now).collect()}
    assert counts == {("targets", "user"): 2, ("targets", "room"): 0, ("year", "2026"): 2}
