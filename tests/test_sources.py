"""Feeds, pages, stores and the publish order."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from digestry.operators import items as item_ops
from digestry.operators import quality
from digestry.sources import feeds, store
from digestry.sources.pages import article_text, page_title

# Every known namespace under an unusual prefix, and foreign elements around the feed's own.
ATOM = (
    "<?xml version='1.0'?><!-- made up --><feed xmlns='http://www.w3.org/2005/Atom' xmlns:p='http://arxiv.org/schemas/atom' xmlns:m='urn:media'>"
    "<entry><m:title>Not this one</m:title><title>Lanterns &amp;\n  Tides</title><m:title>Nor this</m:title><id>http://arxiv.org/abs/2501.00042v3</id>"
    "<published>2025-02-03T04:05:06Z</published><m:link href='https://media.example.net/z'/><summary>On &lt;i&gt;low&lt;/i&gt; water.</summary><m:summary>x</m:summary>"
    "<author><name>Mira Sol</name></author><author><name> Jon Ek </name></author><author><name>Mira Sol</name></author>"
    "<link rel='related' href='https://elsewhere.example.net/q'/><link rel='alternate' href='https://arxiv.org/abs/2501.00042v3'/>"
    "<category term='sea.lamp'/><p:primary_category term='sea.moon'/><category term='sea.lamp'/><p:doi>10.77/XyZ</p:doi></entry>"
    "<entry><id>n1</id><published>2025-02-03T04:05:06Z</published><title> </title><link href='https://a.example.net/b'/></entry>"
    "<entry><id>n2</id><title>No date</title><link href='https://a.example.net/b'/></entry>"
    "<entry><id>n3</id><title>Bad date</title><updated>the day after</updated><link href='https://a.example.net/b'/></entry>"
    "<entry><id>n4</id><title>No address</title><updated>2025-02-03</updated></entry></feed>"
)
RSS = (
    "<rss version='2.0' xmlns:c='http://purl.org/rss/1.0/modules/content/' xmlns:d='http://purl.org/dc/elements/1.1/' xmlns:atom='http://www.w3.org/2005/Atom' xmlns:media='urn:m'>"
    "<channel><title>Harbour notes</title><item><media:description>not this</media:description><title>Ropes and Knots</title><guid>knot-17</guid>"
    "<link>https://notes.example.net/k/17?utm_campaign=z</link><atom:link rel='self' href='https://notes.example.net/feed'/><pubDate>Mon, 03 Feb 25 05:06 EST</pubDate>"
    "<description>&lt;b&gt;Tight&lt;/b&gt; ones.</description><media:description>nor this</media:description><media:content url='x'/>"
    "<author>desk@example.net (Desk of Notes)</author><d:creator>Ola</d:creator><c:encoded> </c:encoded><c:encoded>&lt;p&gt;All of it&lt;/p&gt;</c:encoded></item></channel></rss>"
)


def raw(spark, *pairs):
    return spark.createDataFrame(list(pairs), "source_id string, payload string")


def test_atom_entries(spark):
    rows, errors = feeds.scan_atom(raw(spark, ("tide", ATOM), ("broken", "<feed><entry"), ("empty", "<feed xmlns='http://www.w3.org/2005/Atom'></feed>")))
    got = rows.collect()
    assert len(got) == 1
    row = got[0]
    assert (row["id"], row["title"], row["excerpt"]) == ("arxiv-2501.00042", "Lanterns & Tides", "On low water.")
    assert row["authors"] == ["Mira Sol", "Jon Ek"] and set(row["categories"]) == {"sea.lamp", "sea.moon"} and row["doi"] == "10.77/xyz"
    assert row["url"] == "https://arxiv.org/abs/2501.00042v3" and row["published_at"] == datetime(2025, 2, 3, 4, 5, 6)
    want = {("broken", None, "malformed_feed"), ("tide", 1, "no_title"), ("tide", 2, "no_date"), ("tide", 3, "unreadable_date"), ("tide", 4, "no_address")}
    assert {tuple(r) for r in errors.collect()} == want


def test_rss_entries(spark):
    rows, errors = feeds.scan_blog_feed(raw(spark, ("knots", RSS)))
    row = rows.first()
    assert (row["title"], row["url"], row["published_at"]) == ("Ropes and Knots", "https://notes.example.net/k/17", datetime(2025, 2, 3, 10, 6))
    assert (row["excerpt"], row["authors"], row["feed_content"]) == ("Tight ones.", ["Ola", "Desk of Notes"], "<p>All of it</p>")
    assert errors.count() == 0


def test_a_feed_whose_root_has_a_prefix(spark):
    payload = "<a:feed xmlns:a='http://www.w3.org/2005/Atom'><a:entry><a:title>T</a:title><a:id>i</a:id><a:updated>2025-02-03</a:updated><a:link href='https://x.example.net/1'/></a:entry></a:feed>"
    for scan in (feeds.scan_atom, feeds.scan_blog_feed):
        assert [(r["title"], r["url"]) for r in scan(raw(spark, ("s", payload)))[0].collect()] == [("T", "https://x.example.net/1")]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Mon, 03 Feb 2025 04:05:06 +0130", datetime(2025, 2, 3, 2, 35, 6)), ("3 feb 25 04:05 GMT", datetime(2025, 2, 3, 4, 5)), ("03-Feb-99 04:05:06 PDT", datetime(1999, 2, 3, 11, 5, 6)),
        ("Tue, 12 Aug 2025 05:06 EST", datetime(2025, 8, 12, 10, 6)), ("Sunday, 9 March 2025", datetime(2025, 3, 9)), ("2025-02-03", datetime(2025, 2, 3)), ("2025-02-03 04:05", datetime(2025, 2, 3, 4, 5)),
        ("2025-02-03T04:05:06.25-08:00", datetime(2025, 2, 3, 12, 5, 6, 250000)), ("2025-02-30T00:00:00Z", None), ("31 Nox 2025 01:02 Z", None), ("soon", None), ("", None), (None, None),
    ],
)
def test_dates(spark, text, want):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(feeds._moment(F.col("t"))).first()[0] == want


def test_dead_sources(spark):
    given = raw(spark, ("good", RSS), ("bad", "<rss><channel><item"), ("bad-optional", "<rss"), ("tide", ATOM))
    rows, errors = feeds.scan_blog_feed(given)
    sources = spark.createDataFrame([("good", True, True), ("bad", True, True), ("bad-optional", False, True), ("gone", True, True), ("tide", False, True), ("off", True, False)], "source_id string, required boolean, enabled boolean")
    got = {tuple(r) for r in feeds.source_errors(errors, given, sources).collect()}
    assert got == {
        ("bad", "malformed_feed", "error", 1), ("bad-optional", "malformed_feed", "warning", 1), ("gone", "no_feed", "error", 1),
        ("tide", "no_title", "warning", 1), ("tide", "no_date", "warning", 1), ("tide", "unreadable_date", "warning", 1), ("tide", "no_address", "warning", 1),
    }


def test_blog_feeds_in_other_dialects(spark):
    atom = (
        "<feed xmlns='http://www.w3.org/2005/Atom'><entry><id>e1</id><title>Atom post</title><updated>2026-08-09T00:00:00Z</updated>"
        "<link rel='alternate' href='https://b.org/p1'/><summary>s</summary><author><name>Bo</name></author><content type='html'>&lt;p&gt;full&lt;/p&gt;</content></entry></feed>"
    )
    rdf = (
        "<rdf:RDF xmlns:rdf='http://www.w3.org/1999/02/22-rdf-syntax-ns#' xmlns='http://purl.org/rss/1.0/' xmlns:dc='http://purl.org/dc/elements/1.1/'>"
        "<channel><title>c</title></channel><item><title>RDF post</title><link>https://b.org/p2</link><dc:date>2026-08-08</dc:date><dc:creator>Cy</dc:creator></item></rdf:RDF>"
    )
    rows, errors = feeds.scan_blog_feed(raw(spark, ("a", atom), ("r", rdf)))
    got = {r["source_id"]: (r["title"], r["url"], str(r["published_at"]), r["authors"], r["feed_content"]) for r in rows.collect()}
    assert got == {
        "a": ("Atom post", "https://b.org/p1", "2026-08-09 00:00:00", ["Bo"], "<p>full</p>"),
        "r": ("RDF post", "https://b.org/p2", "2026-08-08 00:00:00", ["Cy"], None),
    }
    assert errors.count() == 0


def test_pages(spark):
    page = "<html><head><title>A &amp; B</title></head><body><nav>menu</nav><!-- x --><article class='m'><p>One</p><script>var a='<p>';</script>two</article><footer>f</footer></body></html>"
    bare = "<body><p>Only &lt;body&gt;</p><style>p{}</style></body>"
    data = spark.createDataFrame([(1, page), (2, bare), (3, "plain"), (4, None)], "k int, html string").orderBy("k")
    assert [tuple(r) for r in data.select(page_title(F.col("html")), article_text(F.col("html"))).collect()] == [
        ("A & B", "One two"), ("", "Only <body>"), ("", "plain"), ("", ""),
    ]


def test_json_lines_skip_blanks_and_fail_on_garbage(spark, tmp_path):
    (tmp_path / "ok.jsonl").write_text('{"id": "a"}\n\n{"id": "b"}\n')
    assert store.read_json_lines(spark, str(tmp_path / "ok.jsonl"), "id string").count() == 2
    (tmp_path / "bad.jsonl").write_text('{"id": "a"}\nnot json\n')
    with pytest.raises(Exception):
        store.read_json_lines(spark, str(tmp_path / "bad.jsonl"), "id string").collect()


def test_documents_unknown_fields_and_paths(spark, tmp_path):
    folder = tmp_path / "items" / "papers" / "2026" / "08"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text('{\n "id": "a", "kind": "paper", "published_at": "2026-08-01T00:00:00Z"\n}')
    (folder / "b.json").write_text('{\n "id": "a2", "kind": "blog", "published_at": "2026-07-01T00:00:00Z"\n}')
    rows = store.read_documents(spark, str(tmp_path), "id string, kind string, published_at timestamp")
    got = {(r["id"], r["rule"]) for r in quality.path_violations(rows, F.col("path")).collect()}
    assert got == {("a2", "path_kind"), ("a2", "path_id"), ("a2", "path_month")}
    lines = spark.createDataFrame([('{"id": "a", "extra": 1}',)], "value string")
    assert [r["field"] for r in store.unknown_fields(lines, ["id"]).collect()] == ["extra"]
    (folder / "c.html").write_text("<p>")
    assert quality.unsupported_files(store.list_files(spark, str(tmp_path))).count() == 1


def test_digest_and_run_paths(spark):
    day = datetime(2026, 8, 1)
    digests = spark.createDataFrame([("d/digests/2026/08/2026-08-01.json", day.date()), ("d/digests/2026/09/2026-08-02.json", day.date())], "path string, digest_date date")
    assert sorted(r["rule"] for r in quality.digest_path_violations(digests, F.col("path")).collect()) == ["path_date", "path_month"]
    runs = spark.createDataFrame([("d/runs/2026/08/r1.json", "r1", day), ("d/runs/2026/08/r1.json", "r2", day)], "path string, run_id string, started_at timestamp")
    assert [r["run_id"] for r in quality.run_path_violations(runs, F.col("path")).collect()] == ["r2"]


def gate(spark, count):
    return quality.publish_gate({"check": spark.range(count).withColumnRenamed("id", "x")})


def test_publish_refuses_and_keeps_the_old_state(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = spark.range(3)
    assert store.current_version(spark, root) is None
    store.publish(gate(spark, 0), {"items": rows}, rows.limit(1), root, "v1")
    with pytest.raises(store.PublishRefused):
        store.publish(gate(spark, 1), {"items": rows}, rows.limit(1), root, "v2")
    assert store.current_version(spark, root) == "v1"
    rows.write.parquet(f"{root}/v3/items")  # a run that died before its state
    assert store.current_version(spark, root) == "v1"


def test_item_sink_respects_the_size_limit(spark, tmp_path):
    rows = spark.createDataFrame([("a", "paper", datetime(2026, 8, 1), "x" * 50), ("b", "blog", datetime(2026, 7, 1), "y")], "id string, kind string, published_at timestamp, text string")
    with pytest.raises(store.PublishRefused):
        store.write_items(rows, str(tmp_path / "i"), 60)
    store.write_items(rows, str(tmp_path / "i"), 4096)
    back = spark.read.json(str(tmp_path / "i"))
    assert {(r["id"], r["folder"], r["year"], r["month"]) for r in back.collect()} == {("a", "papers", 2026, 8), ("b", "blogs", 2026, 7)}
    assert store.write_digest(rows.where("false"), str(tmp_path / "d")) is False


def test_window_bounds_reach_the_scan(spark, tmp_path, now):
    from digestry.operators.collect import in_window

    rows = spark.createDataFrame([("paper", datetime(2026, 8, 1)), ("blog", datetime(2019, 1, 1))], "kind string, published_at timestamp")
    rows.write.parquet(str(tmp_path / "c"))
    fresh = spark.read.parquet(str(tmp_path / "c")).where(in_window(F.col("published_at"), F.col("kind"), now, None))
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PushedFilters" in plan and "GreaterThanOrEqual(published_at,2021-08-15" in plan
    assert [r["kind"] for r in fresh.collect()] == ["paper"]


def test_versions_are_in_order_of_number(spark, tmp_path):
    gate = spark.createDataFrame([("ok", True)], "check string, passed boolean")
    state = spark.range(1)
    for version in ("v9", "v10"):
        store.publish(gate, {}, state, str(tmp_path), version)
    assert store.current_version(spark, str(tmp_path)) == "v10"


ODD_ATOM = """<feed><entry><title>Odd</title><id>urn:odd:1</id><updated>{when}</updated>
<link rel="self" href="https://example.org/self"/><link href="https://example.org/page"/></entry></feed>"""


@pytest.mark.parametrize("when", ["2025-03-04T05:06:00.123456Z", "2025-03-04T05:06Z", "2025-03-04T05:06:00+0000", "2025-03-04T05:06:00Z"])
def test_links_without_rel_and_usual_dates(spark, when):
    rows, _ = feeds.scan_atom(spark.createDataFrame([("s", ODD_ATOM.format(when=when))], "source_id string, payload string"))
    row = rows.first()
    assert row["url"] == "https://example.org/page" and row["published_at"].replace(microsecond=0) == datetime(2025, 3, 4, 5, 6)


def test_guid_stands_for_a_missing_link(spark):
    payload = "<rss><channel><item><title>No link</title><guid>https://example.org/only-guid</guid><pubDate>Tue, 4 Mar 2025 05:06 +0000</pubDate></item></channel></rss>"
    rows, _ = feeds.scan_blog_feed(spark.createDataFrame([("s", payload)], "source_id string, payload string"))
    assert [r["url"] for r in rows.collect()] == ["https://example.org/only-guid"]


def test_graph_document(spark, tmp_path):
    nodes = spark.createDataFrame([("a", ["x"])], "id string, tags array<string>")
    edges = spark.createDataFrame([("e", "a", "b")], "id string, source string, target string")
    store.write_graph(nodes, edges, str(tmp_path / "g"))
    assert spark.read.json(str(tmp_path / "g" / "nodes")).first()["tags"] == ["x"]
    assert spark.read.json(str(tmp_path / "g" / "edges")).count() == 1


def test_upsert_replaces_by_id(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "id string, v int")
    new = spark.createDataFrame([("b", 2), ("c", 2)], "id string, v int")
    assert sorted(tuple(r) for r in item_ops.upsert(old, new).collect()) == [("a", 1), ("b", 2), ("c", 2)]
