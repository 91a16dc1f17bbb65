"""Document fingerprints: chains of content words that follow common words."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from digestry.llm.texts import LETTERS, lower_ascii, text_of, words_of
from digestry.session import stage

# Common words of English, French, German and Spanish.
ANCHORS = (
    "a an and are as at be been but by for from had has have he her his i if in is it its not of on or she so that the their there they this to was we were which will with you "
    "au aux ce cette dans de des du elle en est et il la le les leur mais ne ou par pas plus pour que qui se son sur un une "
    "aber als am auch auf aus bei das dem den der die ein eine einer er es für hat ich im ist mit nach nicht oder sich sie sind um und von war wie zu zum "
    "al como con del el esta este ha las lo los más no o para pero por sin sobre su sus una y"
).split()
CHAIN = 2


def with_spots(df: DataFrame, text: str, out: str, anchors: Sequence[str] = ANCHORS, chain: int = CHAIN) -> DataFrame:
    """Add `out`: the sorted distinct signatures of the text as 32-bit numbers.

    A signature is an anchor with the `chain` content words that come next,
    anchors between them skipped; anchors too near the end have none. A text
    with words but no such spot is described by its chains of content words, or
    as a whole if it is shorter than a chain; text without words by itself. Only
    the empty text has no signature. With `p` the place of an anchor and `k` the
    anchors before it, p - k content words come before, so the chain is a slice.
    """
    words, content, places = f"_{out}_words", f"_{out}_content", f"_{out}_places"
    listed = df.withColumn(words, words_of(lower_ascii(F.col(text)), LETTERS))
    listed = listed.withColumn(places, F.filter(F.transform(words, lambda w, i: F.when(w.isin(*anchors), i)), lambda p: p.isNotNull())).withColumn(content, F.filter(words, lambda w: ~w.isin(*anchors)))
    link = lambda at: [F.get(F.col(content), at + step) for step in range(chain)]
    spotted = F.transform(places, lambda p, k: F.when(p - k + chain <= F.size(content), F.hash(F.get(F.col(words), p), *link(p - k))))
    spotted = F.filter(spotted, lambda s: s.isNotNull())
    plain = F.transform(F.sequence(F.lit(0), F.size(content) - chain), lambda i: F.hash(F.lit(""), *link(i)))
    whole = F.when(F.size(words) > 0, F.hash(F.array_join(words, " "))).otherwise(F.hash(F.col(text)))
    chosen = F.when(F.size("_spotted") > 0, F.col("_spotted")).when(F.size(content) >= chain, plain).when(F.col(text) != "", F.array(whole)).otherwise(F.array().cast("array<int>"))
    return listed.withColumn("_spotted", spotted).withColumn(out, F.array_sort(F.array_distinct(chosen))).drop(words, content, places, "_spotted")


def printed(signatures: Column) -> Column:
    """A fingerprint as text: eight hex digits for each signature, in order."""
    return F.array_join(F.transform(signatures, lambda s: F.lower(F.lpad(F.hex(s.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))), "")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two fingerprints; two empty ones are alike.

    Sets whose sizes differ too much for `least` are not intersected: the ratio
    of the sizes bounds the similarity, and 0 is returned for them.
    """
    low, high = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    return F.when(high == 0, F.lit(1.0)).when(low < F.lit(least) * high, F.lit(0.0)).otherwise(common / (low + high - common))


def in_ranges(df: DataFrame, key: str, ranges: int) -> DataFrame:
    """Add `_part`: the number of the range of `key` that a row falls in, null first.

    The bounds are approximate quantiles over all keys, at most `ranges` numbers.
    """
    shares = [k / ranges for k in range(1, ranges)]
    bounds = df.agg(F.percentile_approx(key, shares, 20_000)).first()[0] if shares else []
    bounds = sorted(set(bounds or []))
    return df.withColumn("_part", F.size(F.filter(F.array(*(F.lit(b) for b in bounds)).cast("array<bigint>"), lambda b: b < F.col(key))))


def with_next(df: DataFrame, columns: Sequence[str], ranges: int | None = None, derive: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Add next_<column> from the row that follows by ascending doc_id; the first follows the last.

    Rows go to ranges of doc_id, and each range also gets a copy of the first row
    of the range after it, so that a window inside the range sees every next row.
    Only the first ids of the ranges are known outside the tasks. Rows that share
    a doc_id are ordered by a hash of their text. `derive` adds columns before
    the window, once for each row and once for each copy.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = in_ranges(df.withColumn("_tie", F.xxhash64("text")), "doc_id", ranges).withColumn("_copy", F.lit(False))
    firsts = placed.groupBy("_part").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("has"), F.col("doc_id"), F.col("_tie"))).alias("first"))
    firsts = stage(firsts.select("_part", F.col("first.doc_id").alias("_id"), F.col("first._tie").alias("_own")), "firsts")  # one row for each range
    every = Window.orderBy("_part")
    last = F.max("_part").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    wanted = firsts.select("_id", "_own", F.coalesce(F.lag("_part").over(every), last).alias("_to"))
    same = placed["doc_id"].eqNullSafe(wanted["_id"]) & (placed["_tie"] == wanted["_own"])
    # One row for each range; equal rows would be copied together, one is enough.
    copies = placed.join(F.broadcast(wanted), same).dropDuplicates(["_to"]).select(*df.columns, "_tie", F.col("_to").alias("_part"), F.lit(True).alias("_copy"))
    both = derive(placed.select(*df.columns, "_tie", "_part", "_copy").unionByName(copies))
    order = Window.partitionBy("_part").orderBy("_copy", F.col("doc_id").asc_nulls_first(), "_tie")
    followed = both.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in columns))
    return followed.where("NOT _copy").drop("_tie", "_part", "_copy")


def fingerprint_digest(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited forms, and how alike they are.

    The edited text has its last quarter (rounded down) replaced by as many code
    points from the start of the next document, or all of it. Null is the empty
    text, whose fingerprint is empty and alike only to itself. Equal rows follow
    each other; a single document follows itself.
    """
    rows = docs.select("doc_id", text_of().alias("text"))
    own = with_next(rows, ["text", "spots"], derive=lambda df: with_spots(df, "text", "spots"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - quarter).cast("int")), F.substring(F.col("next_text"), F.lit(1), quarter))
    cut = own.withColumn("n_chars", F.length("text")).select("doc_id", "n_chars", "spots", "next_spots", edited.alias("edited"))
    both = with_spots(cut, "edited", "edited_spots")
    return both.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        printed(F.col("spots")).alias("fingerprint"),
        printed(F.col("edited_spots")).alias("edited_fingerprint"),
        likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        likeness(F.col("spots"), F.col("next_spots")).alias("near_next"),
    )
