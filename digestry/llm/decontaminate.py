"""Benchmark passages in a corpus: a prefix-filtered set join of shingles, verified over item-sized windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from digestry.llm.texts import LETTERS, lower_ascii, text_of, words_of
from digestry.session import stage

WINDOW = 10
SHINGLE = 3


def shingles_at(words: Column, width: int) -> Column:
    """Array of all shingles of `width` words, in order, as text."""
    parts = [F.slice(words, k + 1, F.greatest(F.size(words) - (width - 1), F.lit(0))) for k in range(width)]
    if width == 1:
        return parts[0]
    return F.zip_with(parts[0], parts[1], lambda a, b: F.concat(a, F.lit(" "), b)) if width == 2 else F.transform(F.arrays_zip(*(p.alias(str(k)) for k, p in enumerate(parts))), lambda z: F.concat_ws(" ", *(z[str(k)] for k in range(width))))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(windows, items): distinct windows `win, words` and the items that have them, `win, item_id`.

    An item of fewer words than a window, but not none, is one window.
    """
    words = benchmark.select("item_id", words_of(lower_ascii(text_of()), LETTERS).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    every = words.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("words", s, window))).alias("words"))
    every = stage(every.select("item_id", "words", F.array_join("words", " ").alias("win")).distinct(), "windows")
    return every.select("win", "words").distinct(), every.select("win", "item_id").distinct()


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """(found, items): where windows occur, `doc_id, body, start, length, win`, and `win, item_id`.

    A set of shingles that is contained whole in another must share each of its
    shingles, so the rarest one is prefix enough. Shingles of documents that the
    benchmark has at all are counted over the whole corpus, which gives the order
    of rarity; each window asks only for its rarest, and only at places where it
    would start at or after the first word and end by the last. What passes is
    verified: every shingle of the window must stand at its own place, and
    shingles are compared as text, so an occurrence is exact. `body` is a hash of
    the text; rows equal in doc_id and text have the same occurrences.

    The benchmark's distinct shingles meet those of the documents in a join that
    the planner broadcasts while they are small and shuffles beyond that.
    """
    windows, items = benchmark_windows(benchmark, window)
    asked = windows.withColumn("width", F.least(F.size("words"), F.lit(shingle)))
    widths = sorted(row["width"] for row in asked.select("width").distinct().collect())  # at most `shingle` numbers
    parts = None
    for width in widths:
        own = asked.where(F.col("width") == width).select("win", F.size("words").alias("length"), F.posexplode(shingles_at(F.col("words"), width)).alias("at", "shingle"))
        parts = own if parts is None else parts.unionByName(own)
    words = docs.select("doc_id", F.xxhash64("text").alias("body"), words_of(lower_ascii(text_of()), LETTERS).alias("words"))
    if parts is None:
        none = words.select("doc_id", "body", F.lit(0).alias("start"), F.lit(0).alias("length"), F.lit("").alias("win")).where("false")
        return none, items
    parts = stage(parts, "parts")
    needles = stage(parts.select("shingle").distinct(), "needles")
    hits = None
    for width in widths:
        own = words.select("doc_id", "body", F.size("words").alias("n_words"), F.posexplode(shingles_at(F.col("words"), width)).alias("pos", "shingle")).join(needles, "shingle")
        hits = own if hits is None else hits.unionByName(own)
    hits = stage(hits, "hits")
    counts = hits.groupBy("shingle").agg(F.count("*").alias("seen"))
    # A window with a shingle that no document has occurs nowhere.
    ranked = parts.join(counts, "shingle", "left").groupBy("win", "length").agg(F.min(F.coalesce("seen", F.lit(0))).alias("least"), F.min(F.struct(F.coalesce("seen", F.lit(0)), "at", "shingle")).alias("prefix"), F.count("*").alias("n_parts"))
    prefixes = ranked.where("least > 0").select("win", "length", "n_parts", F.col("prefix.at").alias("at"), F.col("prefix.shingle").alias("shingle"))
    start = F.col("pos") - F.col("at")
    candidates = hits.join(prefixes, "shingle").where((start >= 0) & (start + F.col("length") <= F.col("n_words"))).select("doc_id", "body", start.alias("start"), "length", "win", "n_parts").distinct()
    candidates = stage(candidates, "candidates")
    expected = candidates.join(parts.select("win", "at", "shingle"), "win").withColumn("pos", F.col("start") + F.col("at"))
    there = hits.select(F.col("doc_id").alias("_doc"), F.col("body").alias("_body"), "pos", "shingle").distinct()
    met = expected.join(there, (expected["body"] == there["_body"]) & (expected["pos"] == there["pos"]) & (expected["shingle"] == there["shingle"]) & expected["doc_id"].eqNullSafe(there["_doc"]), "left_semi")
    found = met.groupBy("doc_id", "body", "start", "length", "win", "n_parts").agg(F.count("*").alias("_met")).where("_met = n_parts")
    return stage(found.select("doc_id", "body", "start", "length", "win"), "found"), items


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row for each document: words, words inside any benchmark window, and the items it has.

    Null and empty texts have no words and are clean. Rows equal in doc_id and
    text give equal rows. An item_id that repeats is one item with the windows of
    all its rows; a null item_id marks words but is neither counted nor listed.
    """
    found, items = find_passages(docs, benchmark, window)
    of_doc = Window.partitionBy("doc_id", "body").orderBy("start", "length")
    # Words between the furthest end so far and this window's end.
    spans = found.groupBy("doc_id", "body", "start").agg(F.max("length").alias("length"))
    reach = F.coalesce(F.max(F.col("start") + F.col("length")).over(of_doc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    end = F.col("start") + F.col("length")
    hit = spans.select("doc_id", "body", F.greatest(end - F.greatest("start", reach), F.lit(0)).alias("new")).groupBy("doc_id", "body").agg(F.sum("new").alias("n_hit"))
    having = found.select("doc_id", "body", "win").distinct().join(items.where("item_id IS NOT NULL"), "win").groupBy("doc_id", "body").agg(F.collect_set(F.col("item_id").cast("string")).alias("ids"))
    marks = hit.join(having, hit["body"].eqNullSafe(having["body"]) & hit["doc_id"].eqNullSafe(having["doc_id"]), "left").select(hit["doc_id"].alias("_doc"), hit["body"].alias("_body"), "n_hit", "ids")
    marks = stage(marks, "marks")
    counted = docs.select("doc_id", F.xxhash64("text").alias("body"), F.regexp_count(lower_ascii(text_of()), F.lit(LETTERS)).cast("long").alias("n_words"))
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return counted.join(marks, (F.col("body") == F.col("_body")) & F.col("doc_id").eqNullSafe(F.col("_doc")), "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(ids), ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of `docs` without a benchmark window, columns as they are."""
    found, _ = find_passages(docs, benchmark, window)
    bad = found.select(F.col("doc_id").alias("_doc"), F.col("body").alias("_body")).distinct()
    keyed = docs.withColumn("_of", F.xxhash64("text"))
    return keyed.join(bad, (F.col("_of") == F.col("_body")) & F.col("doc_id").eqNullSafe(F.col("_doc")), "left_anti").select(*docs.columns)
