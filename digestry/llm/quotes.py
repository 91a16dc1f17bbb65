"""Chat formatting: quoted passages linked to the messages they come from, conversations without quotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from digestry.llm.ordered import running_sums
from digestry.llm.texts import text_of
from digestry.session import stage

# Quote marks at the start of a line, and the line that announces a quote.
MARKS = r"^(?:[\x20\t]*>)+"
ANNOUNCES = r"(?i)^[\x20\t]*(?:on|am|le|el)\b.{0,200}(?:wrote|schrieb|a écrit|escribió)[^:]{0,200}:[\x20\t]*$"
# Sentence ends, after which a passage is cut for hashing.
ENDS = r"(?<=[.!?])[\x20]+"
LEAST_WORDS = 2


def normalised(text: Column) -> Column:
    """Lower case, with runs of anything but letters and digits as one space."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def sentences(passage: Column) -> Column:
    """Hashes of the normalised sentences of a passage, those of fewer than LEAST_WORDS words left out unless it is all there is."""
    parts = F.filter(F.transform(F.split(F.regexp_replace(passage, r"\s+", " "), ENDS), normalised), lambda s: s != "")
    long_ones = F.filter(parts, lambda s: F.size(F.split(s, " ")) >= LEAST_WORDS)
    return F.array_distinct(F.transform(F.when(F.size(long_ones) > 0, long_ones).otherwise(parts), lambda s: F.xxhash64(s)))


def quote_lines(messages: DataFrame) -> DataFrame:
    """Add `lines`: an array of (level, body), level 0 being the message's own words.

    The level is the number of '>' marks before a line. A line that announces a
    quote ("On ... wrote:") right above one belongs to the quote and is left out.
    """
    raw = messages.withColumn("_raw", F.split(text_of(), r"\r?\n"))
    marks = lambda line: F.regexp_extract(line, MARKS, 0)
    level = lambda line: F.length(F.translate(marks(line), " \t", ""))
    parsed = F.transform("_raw", lambda line, i: F.struct(level(line).alias("level"), F.regexp_replace(line, MARKS + r"[\x20]?", "").alias("body"), line.rlike(ANNOUNCES).alias("announces"), i.alias("i")))
    levelled = raw.withColumn("_parsed", parsed)
    quoted_next = lambda x: F.coalesce(F.get(F.col("_parsed"), x["i"] + 1)["level"], F.lit(0)) > x["level"]
    kept = F.filter("_parsed", lambda x: ~(x["announces"] & quoted_next(x)))
    return levelled.withColumn("lines", F.transform(kept, lambda x: F.struct(x["level"].alias("level"), x["body"].alias("body")))).drop("_raw", "_parsed")


def passages(lined: DataFrame) -> DataFrame:
    """row, conv_id, turn, level, place and text: runs of lines of one quote level, in order of place."""
    each = lined.select("row", "conv_id", "turn", F.posexplode("lines").alias("at", "line")).select("row", "conv_id", "turn", "at", F.col("line.level").alias("level"), F.col("line.body").alias("body"))
    own = Window.partitionBy("row").orderBy("at")
    changed = each.withColumn("_new", F.coalesce((F.col("level") != F.lag("level").over(own)).cast("int"), F.lit(1)))
    runs = changed.withColumn("place", F.sum("_new").over(own))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "body"))), lambda x: x["body"]), " ")
    return runs.groupBy("row", "conv_id", "turn", "level", "place").agg(body.alias("text"))


def link_quotes(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, links): messages with their lines, and for each quoted passage the turn it comes from.

    `links` has row, place, level, sentences, matched and source_turn. A sentence
    belongs to the first message of its conversation that says it in its own
    words, so hashes meet at most one original each and no conversation is joined
    with itself; the passage goes to the earlier turn that has most of its
    sentences, the latest of these if several have as many. A passage that no
    earlier message has keeps a null source.
    """
    rows = stage(quote_lines(messages).withColumn("row", F.monotonically_increasing_id()), "messages")
    found = stage(passages(rows).withColumn("hashes", sentences(F.col("text"))).drop("text"), "passages")
    said = found.where("level = 0").select("conv_id", "turn", F.explode("hashes").alias("hash")).groupBy("conv_id", "hash").agg(F.min("turn").alias("source_turn"))
    asked = found.where("level > 0").select("row", "conv_id", "turn", "place", "level", F.size("hashes").alias("sentences"), "hashes")
    each = asked.select("row", "conv_id", "turn", "place", F.explode("hashes").alias("hash"))
    same = each["conv_id"].eqNullSafe(said["conv_id"]) & (each["hash"] == said["hash"])
    met = each.join(said, same).where("source_turn < turn").groupBy("row", "place", "source_turn").agg(F.count("*").alias("matched"))
    best = met.groupBy("row", "place").agg(F.max(F.struct("matched", "source_turn")).alias("best"))
    links = asked.drop("hashes", "conv_id", "turn").join(best, ["row", "place"], "left").select("row", "place", "level", "sentences", F.coalesce("best.matched", F.lit(0)).alias("matched"), F.col("best.source_turn").alias("source_turn"))
    return rows, stage(links, "links")


def reply_paths(rows: DataFrame, links: DataFrame) -> DataFrame:
    """row, parent_turn, depth and path: the turns from the start of a thread to the message.

    A message answers the source of its outermost quotes, the latest one if there
    are several. Paths are doubled: in each round a message takes over the path
    of the last ancestor it knows, so a chain of n replies takes log2(n) rounds.
    A parent is always an earlier turn, so there are no cycles. Where a turn
    number is repeated in a conversation, its first row is the parent.
    """
    parents = links.where("level = 1 AND source_turn IS NOT NULL").groupBy("row").agg(F.max("source_turn").alias("parent_turn"))
    known = rows.select("row", "conv_id", "turn").join(parents, "row", "left")
    state = stage(known.select("row", "conv_id", "turn", "parent_turn", F.array("turn").alias("path"), F.col("parent_turn").alias("ahead")), "paths")
    while state.where("ahead IS NOT NULL").limit(1).count():
        first = state.groupBy("conv_id", "turn").agg(F.min("row").alias("row"))
        above = state.join(first.select("row"), "row", "left_semi").select(F.col("conv_id").alias("_conv"), F.col("turn").alias("_turn"), F.col("path").alias("_path"), F.col("ahead").alias("_ahead"))
        going, done = state.where("ahead IS NOT NULL"), state.where("ahead IS NULL")
        same = going["conv_id"].eqNullSafe(above["_conv"]) & (going["ahead"] == above["_turn"])
        moved = going.join(above, same).select("row", "conv_id", "turn", "parent_turn", F.concat("_path", "path").alias("path"), F.col("_ahead").alias("ahead"))
        state = stage(done.unionByName(moved), "paths")
    return state.select("row", "parent_turn", (F.size("path") - 1).cast("long").alias("depth"), "path")


def chat_messages(messages: DataFrame) -> DataFrame:
    """One row for each message: its place in reply order, whom it answers, and its own words without quotes.

    `seq` numbers the messages of a conversation from 0 in reply order: threads by
    first turn, answers below what they answer (depth first), equal turns by row
    order of their text. `formatted` is the message as one chat turn. Null texts
    are empty; rows without conv_id form one conversation; a null turn comes first
    and is nobody's parent. Numbers come from running sums over ranges, so a
    conversation that holds a third of all messages is spread over many tasks.
    """
    rows, links = link_quotes(messages)
    paths = reply_paths(rows, links)
    counted = links.groupBy("row").agg(F.count("*").alias("n_quotes"), F.sum(F.col("source_turn").isNotNull().cast("long")).alias("n_linked"))
    own = F.trim(F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["body"]), "\n"))
    plain = rows.select("row", "conv_id", "turn", "role", F.regexp_replace(own, r"\n{3,}", "\n\n").alias("text"), F.lit(1).alias("one"))
    ordered = running_sums(paths.join(rows.select("row", "conv_id"), "row").select("conv_id", "path", "row", "parent_turn", "depth", F.lit(1).alias("one")), [F.col("conv_id").asc_nulls_first(), F.col("path"), F.col("row")], {"seq": "one"}, within=["conv_id"], name="order")
    none = F.lit(0).cast("long")
    return (
        plain.drop("one")
        .join(ordered.select("row", "seq", "parent_turn", "depth"), "row")
        .join(counted, "row", "left")
        .select("conv_id", "turn", "role", F.col("seq").cast("long").alias("seq"), "parent_turn", "depth", F.coalesce("n_quotes", none).alias("n_quotes"), F.coalesce("n_linked", none).alias("n_linked"), "text", F.concat(F.lit("<|"), F.coalesce("role", F.lit("user")), F.lit("|>\n"), F.col("text"), F.lit("\n<|end|>\n")).alias("formatted"))
    )
