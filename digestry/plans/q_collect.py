"""Scans, identity, windows, history, term matching and prefilter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from digestry.functions.identity import stable_id
from digestry.functions.text import bounded_text, normalize_title
from digestry.functions.urls import normalize_url
from digestry.operators import collect, history, prefilter, scoring, terms
from digestry.operators.items import explode_labels
from digestry.config import source_frame
from digestry.plans import roles
from digestry.plans.catalog import query
from digestry.plans.roles import NOW, SETTINGS, TAXONOMY, joined, stamp
from digestry.session import scratch_path, stage
from digestry.sources import feeds, store


@query
def item_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items as JSON documents by year, read back with an explicit schema."""
    items = roles.items(spark, sf_dir).select(
        "id", "kind", "title", stamp(F.col("published_at")).alias("published"), "targets", "relevance_score",
        F.date_format("published_at", "yyyy").alias("year"),
    )
    path = scratch_path(spark, "items")
    items.hint("rebalance", "year").write.partitionBy("year").json(path)
    schema = "id string, kind string, title string, published string, targets array<string>, relevance_score double"
    return store.read_documents(spark, path, schema, multi_line=False).select(
        "id", "kind", "title", "published", joined(F.col("targets")).alias("targets"),
        F.round("relevance_score", 6).alias("relevance"),
    )


@query
def stage_jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = roles.candidates(spark, sf_dir).withColumn("feed_content", F.lit("transient"))
    path = scratch_path(spark, "candidates")
    store.write_json_lines(rows.select("row_key", "kind", "id", "title", "excerpt", "feed_content"), path)
    back = store.read_json_lines(
        spark, path, "row_key bigint, kind string, id string, title string, excerpt string, feed_content string"
    )
    return back.select(
        "row_key", "kind", "id", "title", F.md5("excerpt").alias("excerpt_hash"),
        F.col("feed_content").isNull().alias("dropped"),
    )


@query
def taxonomy_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The public label list, with how many candidates carry each label."""
    used = explode_labels(roles.annotated(spark, sf_dir), "row_key").groupBy("grp", F.col("label").alias("id")).agg(
        F.count("*").alias("n")
    )
    return TAXONOMY.frame(spark).join(used, ["grp", "id"], "left").select(
        "grp", F.col("ord").cast("bigint").alias("ord"), "id", "name_zh", "name_en", F.coalesce("n", F.lit(0)).alias("n")
    )


@query
def excerpt_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    limit = SETTINGS.max_excerpt_chars
    docs = roles.table(spark, sf_dir, "documents").select(
        F.lit("paper").alias("kind"), F.col("doc_id").alias("row_key"), bounded_text(F.col("text"), limit).alias("t")
    )
    pages = roles.table(spark, sf_dir, "pages").select(
        F.lit("blog").alias("kind"), F.col("page_id").alias("row_key"), bounded_text(F.col("html"), limit).alias("t")
    )
    return docs.union(pages).select(
        "kind", "row_key", F.length("t").cast("bigint").alias("n_chars"), F.md5("t").alias("hash")
    )


@query
def url_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page address in seven spellings."""
    bare = F.regexp_replace("url", "^https?://", "")
    spellings = F.array(
        F.col("url"),
        F.concat(F.lit("HTTP://"), bare),
        F.concat(F.lit("http://user:secret@"), bare),
        F.concat(F.lit("ftp://"), bare),
        F.concat(F.regexp_replace("url", "[?#].*$", ""), F.lit("/?zeta=1&utm_Medium=mail&alpha&fbclid=9")),
        F.regexp_replace("url", r"\.(com|net|org)", ".$1:443"),
        F.regexp_replace("url", r"\.(com|net|org)", ".$1:99999"),
    )
    return roles.table(spark, sf_dir, "pages").select("page_id", F.posexplode(spellings).alias("v", "u")).select(
        "page_id", F.col("v").cast("bigint").alias("variant"), normalize_url(F.col("u")).alias("canonical")
    )


@query
def candidate_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four identity sources in turn: arXiv field, DOI, address, title, and the arXiv entry address."""
    key = F.col("row_key")
    text_key = key.cast("string")
    docs = roles.paper_candidates(spark, sf_dir)
    arxiv = F.when(key % 6 == 0, F.concat(F.lit("arXiv:2401."), text_key, F.lit("v"), (key % 4).cast("string")))
    doi = F.when(key % 6 == 1, F.concat(F.lit(" <https://doi.org/10.5/Ab_"), text_key, F.lit(".>"))).when(
        key % 6 == 2, F.lit("11.1/none")
    )
    url = F.when(key % 6 == 3, F.concat(F.lit("https://Papers.example.org/p/"), text_key, F.lit("/?utm_source=x")))
    entry = F.when(key % 6 == 4, F.concat(F.lit("http://arxiv.org/abs/cs/"), text_key, F.lit("v2")))
    papers = docs.select("row_key", "kind", stable_id(F.col("title"), url, arxiv, doi, entry).alias("id"))
    pages = roles.blog_candidates(spark, sf_dir)
    blogs = pages.select("row_key", "kind", stable_id(F.col("title"), F.col("url")).alias("id"))
    return papers.union(blogs)


@query
def candidate_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = collect.dedupe_collected(roles.candidates(spark, sf_dir).drop("excerpt", "categories"))
    return best.select("id", "kind", "row_key", "source_id", stamp(F.col("published_at")).alias("published"))


@query
def query_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows per source: cold for even source numbers, from the last seen item for the others."""
    number = F.substring("source_id", 4, 9).cast("int")
    states = roles.paper_candidates(spark, sf_dir).groupBy("source_id").agg(
        F.max("published_at").alias("newest")
    ).select("source_id", F.when(number % 2 == 1, F.col("newest")).alias("last_success_at"))
    windows = collect.query_windows(states, NOW)
    return windows.select(
        "source_id", "kind", stamp(F.col("since")).alias("since"), stamp(F.col("until")).alias("until")
    )


@query
def windowed_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental window with weights from the source list."""
    rows = roles.candidates(spark, sf_dir).select("row_key", "kind", "source_id", "published_at")
    fresh = rows.where(collect.in_window(F.col("published_at"), F.col("kind"), NOW, roles.LAST_SUCCESS))
    weighted = collect.attach_sources(fresh, source_frame(spark, roles.SOURCES), roles.BLOG_WEIGHT)
    return weighted.select(
        "row_key", "kind", "source_id", stamp(F.col("published_at")).alias("published"), "source_weight"
    )


@query
def history_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.history(spark, sf_dir)


@query
def history_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = collect.dedupe_collected(roles.candidates(spark, sf_dir).drop("excerpt", "categories"))
    return history.drop_history(best, roles.history(spark, sf_dir)).select("id", "kind", "row_key")


@query
def term_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.annotated(spark, sf_dir).select("kind", "row_key", F.explode("hits").alias("term"))


def large_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the benchmark, every word with the next one, and every word with the sign behind it."""
    items = roles.table(spark, sf_dir, "benchmark")
    runs = terms.token_runs(items, [], normalize_title(F.col("text")), [terms.Form(n, True) for n in (1, 2, 3)])
    return runs.where(F.col("term").rlike(r"(?U)^(\w+|\w+[^\w\s]|\w+ \w+)$"))


@query
def term_matches_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of a table found in every candidate: how many, and a digest of them."""
    text = terms.candidate_text(F.col("title"), F.col("excerpt"), F.col("categories"))
    texts = roles.candidates(spark, sf_dir).select("kind", "row_key", text.alias("text_norm"))
    found = terms.matched_terms(texts, large_vocabulary(spark, sf_dir), ["row_key", "kind"])
    return found.select(
        "kind", "row_key", F.size("terms").cast("bigint").alias("n_terms"), F.md5(F.array_join("terms", "|")).alias("terms_hash")
    )


@query
def term_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = F.col("hits")
    return roles.annotated(spark, sf_dir).select(
        "kind", "row_key",
        F.round(terms.term_coverage(hits, TAXONOMY.evidence_terms()), 6).alias("evidence"),
        F.round(scoring.topic_relevance(hits, TAXONOMY), 6).alias("topic"),
        F.round(scoring.scenario_relevance(hits, TAXONOMY), 6).alias("scenario"),
    )


@query
def collection_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.annotated(spark, sf_dir).where("has_evidence").select("kind", "row_key", "id")


@query
def metadata_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.annotated(spark, sf_dir).select(
        "kind", "row_key", "id", F.round("metadata_score", 6).alias("score")
    )


@query
def prefilter_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole first stage: window, identity, dedupe, history, evidence, score, best of each kind."""
    best = prefilter.top_candidates(roles.eligible_candidates(spark, sf_dir), SETTINGS)
    return best.select(
        "id", "kind", "row_key", "source_id", F.col("kind_rank").cast("bigint").alias("kind_rank"),
        F.round("metadata_score", 6).alias("score"),
    )


def _xml(text):
    """Text made safe inside an XML element."""
    out = F.regexp_replace(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", " ")
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


def _payloads(rows: DataFrame, entry, head: str, tail: str, per_feed: int) -> DataFrame:
    """Feeds of at most `per_feed` entries; the row key decides the feed, so no group grows with a source."""
    grouped = rows.select(F.floor(F.col("row_key") / per_feed).alias("feed"), "row_key", entry.alias("x"))
    body = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("row_key", "x"))), lambda e: e["x"]), ""
    )
    return grouped.groupBy("feed").agg(F.concat(F.lit(head), body, F.lit(tail)).alias("payload")).select(
        F.concat(F.lit("feed"), F.col("feed").cast("string")).alias("source_id"), "payload"
    )


@query
def feed_atom_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents wrapped into Atom payloads and scanned; whole texts go through the parser."""
    key = F.col("row_key").cast("string")
    entry = F.concat(
        F.lit("<entry><id>http://arxiv.org/abs/24."), key, F.lit("v1</id><title>"), _xml(F.col("title")),
        F.lit("</title><published>"), F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z</published><summary>"),
        _xml(F.col("excerpt")), F.lit("</summary><author><name> Ada </name></author><author><name>"),
        F.col("source_id"), F.lit("</name></author><link href='https://arxiv.org/abs/24."), key,
        F.lit("v1' rel='alternate'/><category term='"), F.element_at("categories", 1),
        F.lit("'/></entry>"),
    )
    raw = _payloads(
        roles.paper_candidates(spark, sf_dir), entry,
        "<?xml version='1.0'?><feed xmlns='http://www.w3.org/2005/Atom'>", "</feed>", 20,
    )
    rows, _ = feeds.scan_atom(raw)
    return rows.select(
        "id", "title", "url", stamp(F.col("published_at")).alias("published"), F.md5("excerpt").alias("excerpt_hash"),
        F.array_join("authors", ";").alias("authors"), F.array_join("categories", ";").alias("categories"),
    )


@query
def feed_rss_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages wrapped into RSS payloads, full article included, and scanned; every ninth has no link and is dropped."""
    key = F.col("row_key").cast("string")
    link = F.when(F.col("row_key") % 9 == 0, F.lit("")).otherwise(_xml(F.col("url")))
    entry = F.concat(
        F.lit("<item><guid>g"), key, F.lit("</guid><title>"), _xml(_xml(F.col("title"))), F.lit("</title><link>"), link,
        F.lit("</link><pubDate>"), F.date_format("published_at", "EEE, dd MMM yyyy HH:mm:ss"),
        F.lit(" +0000</pubDate><description>"), _xml(_xml(F.col("excerpt"))),
        F.lit("</description><author>a@example.com (Ann)</author><content:encoded>"),
        _xml(F.col("excerpt")), F.lit("</content:encoded></item>"),
    )
    raw = _payloads(
        roles.blog_candidates(spark, sf_dir), entry,
        "<?xml version='1.0'?><rss version='2.0'><channel>", "</channel></rss>", 10,
    )
    rows, _ = feeds.scan_blog_feed(raw, SETTINGS.max_excerpt_chars)
    return rows.select(
        "id", "title", "url", stamp(F.col("published_at")).alias("published"), F.md5("excerpt").alias("excerpt_hash"),
        F.array_join("authors", ";").alias("authors"), F.md5("feed_content").alias("content_hash"),
    )




def odd_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as RSS of eight sorts: foreign elements, mail dates with zone names, no link, no date; every seventh feed is cut off."""
    key = F.col("row_key")
    sort, address = key % 8, F.concat(F.lit("https://odd.example.org/p/"), key.cast("string"))
    local = F.col("published_at") - F.make_interval(hours=F.lit(5))
    east = F.col("published_at") + F.make_interval(hours=F.lit(8))

    def element(name: str, value) -> object:
        return F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))

    date = (
        F.when(sort == 1, element("pubDate", F.concat(F.date_format(local, "EEE, dd MMM yy HH:mm"), F.lit(" EST"))))
        .when(sort == 3, element("pubDate", F.lit("some day")))
        .when(sort == 5, F.lit(""))
        .when(sort == 6, element("d:date", F.concat(F.date_format(east, "yyyy-MM-dd'T'HH:mm"), F.lit("+08:00"))))
        .otherwise(element("pubDate", F.concat(F.date_format("published_at", "dd MMM yyyy HH:mm:ss"), F.lit(" +0000"))))
    )
    link = F.when((sort == 2) | (sort == 7), F.lit("")).otherwise(element("link", address))
    guid = element("guid", F.when(sort == 2, address).otherwise(F.concat(F.lit("g"), key.cast("string"))))
    title = element("title", F.when(sort == 4, F.lit(" ")).otherwise(_xml(_xml(F.col("title")))))
    foreign = F.lit("<media:title>foreign</media:title><media:link>https://foreign.example.org</media:link><media:description>foreign</media:description>")
    entry = F.concat(F.lit("<item>"), foreign, title, link, guid, date, element("description", _xml(_xml(F.col("excerpt")))), foreign, F.lit("</item>"))
    head = "<rss version='2.0' xmlns:media='urn:media' xmlns:d='http://purl.org/dc/elements/1.1/'><channel>"
    whole = _payloads(roles.paper_candidates(spark, sf_dir), entry, head, "</channel></rss>", 10)
    number = F.substring("source_id", 5, 9).cast("int")
    return whole.withColumn("payload", F.when(number % 7 == 3, F.substring("payload", 1, 150)).otherwise(F.col("payload")))


@query
def feed_odd_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = feeds.scan_blog_feed(odd_feeds(spark, sf_dir), SETTINGS.max_excerpt_chars)
    return rows.select("id", "title", "url", stamp(F.col("published_at")).alias("published"), F.md5("excerpt").alias("excerpt_hash"))


@query
def feed_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead sources and dropped entries of a collection run; one required source has no feed at all."""
    given = stage(odd_feeds(spark, sf_dir), "payloads")
    number = F.substring("source_id", 5, 9).cast("int")
    known = given.select("source_id", (number % 2 == 0).alias("required"), (number % 11 != 5).alias("enabled"))
    gone = spark.createDataFrame([("gone", True, True)], known.schema)
    _, errors = feeds.scan_blog_feed(given, SETTINGS.max_excerpt_chars)
    return feeds.source_errors(errors, given, known.unionByName(gone))
