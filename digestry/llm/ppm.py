"""Scoring texts by prediction by partial matching over bytes, and by a unigram base."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from digestry.llm.lean import lean
from digestry.llm.texts import crc_mod, text_of
from digestry.session import stage

# A byte that UTF-8 never has: what stands before a text, and the symbol that ends it.
EDGE = 0xFF
SYMBOLS = 256
# Bytes that are coded at once, and distinct words held before they are passed on.
PIECE = 1 << 22
HELD_WORDS = 400_000


@dataclass(frozen=True)
class PpmSettings:
    """`order` bytes of context, at most 6. Grams that make up at least one part in `parts` of all training bytes are
    looked up while scanning, and words that make up one part in `head` of the tokens: of both the most frequent only,
    at most `most_grams` and `most_words`. All others are scored by joins with the full counts, so no setting changes a
    score. Shares, not ranks, decide where these bounds leave room, so what is joined grows as the input does.
    """

    order: int = 5
    parts: int = 1 << 23
    head: int = 1 << 20
    most_grams: int = 1 << 20
    most_words: int = 1 << 17


def grams(text: bytes, order: int) -> Iterator[np.ndarray]:
    """For every byte of a text and its end, the byte and the `order` before it as one number, in pieces."""
    padded = np.frombuffer(bytes([EDGE]) * order + text + bytes([EDGE]), np.uint8)
    for at in range(0, len(padded) - order, PIECE):
        own = padded[at : at + PIECE + order].astype(np.uint64)
        count = len(own) - order
        codes = own[order:].copy()
        for back in range(1, order + 1):
            codes |= own[order - back : order - back + count] << np.uint64(8 * back)
        yield codes


def gathered(order: int):
    """Texts to counts of grams (word null) and of words (gram null; the empty word is the end)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[bytes] = Counter()

        def word_rows():
            return pa.RecordBatch.from_arrays([pa.nulls(len(words), pa.int64()), pa.array(list(words), pa.binary()), pa.array(list(words.values()), pa.int64())], ["gram", "word", "n"])

        held: list[np.ndarray] = []
        size = 0

        def gram_rows():
            codes, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int64)), pa.nulls(len(codes), pa.binary()), pa.array(counts.astype(np.int64))], ["gram", "word", "n"])

        for batch in batches:
            for text in batch.column("text").to_pylist():
                lowered = text.encode().lower()
                words.update(lowered.split())
                words[b""] += 1
                for codes in grams(lowered, order):
                    held.append(codes)
                    size += len(codes)
                    if size > PIECE:
                        yield gram_rows()
                        held, size = [], 0
                if len(words) > HELD_WORDS:
                    yield word_rows()
                    words.clear()
        if held:
            yield gram_rows()
        if words:
            yield word_rows()

    return run


class Trie:
    """The model in memory, which may be pruned; `lengths_of` and `novel_lengths` are the same rules on whole tables.

    Contexts of 0 to `order` bytes with the symbols seen after them, as sorted arrays.

    If a context has a symbol, so has every shorter one. Hence the symbols to
    exclude after an escape are those of the context just left, and their weight
    in the shorter context is a fixed number for each context.
    """

    def __init__(self, order: int, levels: np.ndarray, codes: np.ndarray, counts: np.ndarray, totals: np.ndarray):
        self.order = order
        self.levels = []
        shorter = None
        for level in range(order + 1):
            own = levels == level
            at = np.argsort(codes[own])
            entries, seen = codes[own][at].astype(np.uint64), counts[own][at].astype(np.float64)
            contexts, first, distinct = np.unique(entries >> np.uint64(8), return_index=True, return_counts=True)
            total = totals[own][at][first].astype(np.float64)
            kept = np.add.reduceat(seen, first) if len(first) else np.zeros(0)
            excluded = np.zeros(len(contexts))
            if shorter is not None and len(first):
                place = np.searchsorted(shorter[0], entries & self.mask(level))
                excluded = np.add.reduceat(shorter[1][place], first)
            self.levels.append((entries, seen, contexts, total, total - kept + distinct, distinct, excluded))
            shorter = (entries, seen)

    @staticmethod
    def mask(size: int) -> np.uint64:
        return np.uint64((1 << 8 * size) - 1)

    @staticmethod
    def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(table):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        place = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return place, table[place] == keys

    def lengths(self, codes: np.ndarray) -> np.ndarray:
        """-log10 of the probability of each gram's last byte after the others.

        A context met T times has D symbols in the model, which make up K of T. A
        symbol met c times has c / (T + D), and the escape has the rest: the symbols
        that were pruned and one for each that is known. Weight and symbols excluded
        are taken off first. Below order 0 all symbols not excluded are alike.
        """
        length = np.zeros(len(codes))
        left = np.arange(len(codes))
        excluded, gone = np.zeros(len(codes)), np.zeros(len(codes))
        for level in range(self.order, -1, -1):
            entries, seen, contexts, total, escape, distinct, weight = self.levels[level]
            if not len(contexts):
                continue
            own = codes[left]
            context, known = self.find(contexts, (own >> np.uint64(8)) & self.mask(level))
            place, there = self.find(entries, own & self.mask(level + 1))
            whole = total[context] - excluded + distinct[context] - gone
            length[left[there]] += np.log10(whole[there]) - np.log10(seen[place[there]])
            rest = escape[context] - gone
            out = known & ~there & (rest > 0)
            length[left[out]] += np.log10(whole[out]) - np.log10(rest[out])
            left, context, known = left[~there], context[~there], known[~there]
            excluded, gone = np.where(known, weight[context], 0), np.where(known, distinct[context], 0)
        length[left] += np.log10(SYMBOLS - gone)
        return length


def scorer(order: int, codes: np.ndarray, lengths: np.ndarray, head: dict[bytes, float]):
    """Sums over the grams (sorted `codes`) and words that are looked up, and the distinct others with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, rest, times, sums, known, tokens, tails = [], [], [], [], [], [], []
            for text in batch.column("text").to_pylist():
                lowered = text.encode().lower()
                score, others, counts = 0.0, [], []
                for part in grams(lowered, order):
                    own, n = np.unique(part, return_counts=True)
                    place, there = Trie.find(codes, own)
                    score -= float((lengths[place[there]] * n[there]).sum())
                    others.append(own[~there].astype(np.int64))
                    counts.append(n[~there].astype(np.int32))
                scores.append(score)
                rest.append(np.concatenate(others))
                times.append(np.concatenate(counts))
                words = [*lowered.split(), b""]
                found = [head.get(w) for w in words]
                tails.append([w for w, x in zip(words, found, strict=True) if x is None])
                sums.append(sum(x for x in found if x is not None))
                known.append(len(words) - len(tails[-1]))
                tokens.append(len(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(sums, pa.float64()), pa.array(scores, pa.float64()), pa.array(tails, pa.list_(pa.binary())), pa.array(rest, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int32()))],
                ["doc_id", "held_out", "n_tokens", "known", "logs", "seen_score", "tail", "grams", "times"],
            )

    return run


def looked_up(counts: DataFrame, total: int, parts: int, most: int) -> DataFrame:
    """The rows of `counts` whose n is at least one part in `parts` of `total`, the most frequent ones only and at most `most`."""
    step = F.floor(F.log2("n") * 16)  # some hundred values whatever the counts
    frequent = counts.where(F.col("n") * parts >= total)
    least, rows = None, 0
    for found in sorted(frequent.groupBy(step.alias("step")).count().collect(), reverse=True):
        rows += found["count"]
        if rows > most:
            break
        least = found["step"]
    return frequent.where(F.lit(False) if least is None else step >= least)


def mask(size: int) -> Column:
    return F.lit((1 << 8 * size) - 1).cast("long")


def context_of(code: Column) -> Column:
    return F.shiftrightunsigned(code, 8)


def lengths_of(counts: DataFrame) -> DataFrame:
    """gram, n, length: -log10 of the probability of each gram that has been seen. A context has at most 256 symbols."""
    own = Window.partitionBy(context_of(F.col("gram")))
    return counts.select("gram", "n", (F.log10(F.sum("n").over(own) + F.count("*").over(own)) - F.log10("n")).alias("length"))


def novel_lengths(novel: DataFrame, counts: DataFrame, order: int) -> DataFrame:
    """gram, length of grams that have never been seen: escapes from the longest context down, as in `Trie.lengths`.

    Each order has a table of its distinct entries. Only contexts that a novel
    gram has are described: how often they were met, by how many symbols, and how
    often these were met in the shorter context. Tables of order 0 and 1 have at
    most 65 536 rows whatever the corpus, and go to every task.
    """
    entries = {order: counts.select(F.col("gram").alias("code"), "n")}
    for level in range(order - 1, -1, -1):
        entries[level] = stage(entries[level + 1].select(F.col("code").bitwiseAND(mask(level + 1)).alias("code"), "n").groupBy("code").agg(F.sum("n").alias("n")), f"order{level}", tidy=True)
    small = lambda df, level: F.broadcast(df) if level < 2 else df
    none = F.lit(0).cast("long")
    state = novel.select("gram", F.lit(0.0).alias("length"), F.lit(False).alias("done"), none.alias("gone"), none.alias("excluded"))
    for level in range(order, -1, -1):
        context = context_of(F.col("gram")).bitwiseAND(mask(level))
        own = entries[level].select("code", "n", context_of(F.col("code")).alias("context"))
        if level > 1:
            own = own.join(novel.select(context.alias("context")).distinct(), "context", "left_semi")
        if level:
            shorter = entries[level - 1].select(F.col("code").alias("_short"), F.col("n").alias("less"))
            own = own.join(small(shorter, level - 1), F.col("code").bitwiseAND(mask(level)) == F.col("_short"))
        else:
            own = own.withColumn("less", none)
        contexts = own.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("symbols"), F.sum("less").alias("less"))
        met = entries[level].select(F.col("code").alias("_code"), F.col("n").alias("seen"))
        state = state.withColumn("_context", context).withColumn("_entry", F.col("gram").bitwiseAND(mask(level + 1)))
        state = state.join(small(contexts, level), F.col("_context") == F.col("context"), "left").join(small(met, level), F.col("_entry") == F.col("_code"), "left")
        whole = F.log10(F.col("total") - F.col("excluded") + F.col("symbols") - F.col("gone"))
        left = F.col("symbols") - F.col("gone")
        more = F.when(F.col("done") | F.col("total").isNull(), 0.0).when(F.col("seen").isNotNull(), whole - F.log10("seen")).when(left > 0, whole - F.log10(left)).otherwise(0.0)
        state = state.select("gram", (F.col("length") + more).alias("length"), (F.col("done") | F.col("seen").isNotNull()).alias("done"), F.coalesce("symbols", none).alias("gone"), F.coalesce("less", none).alias("excluded"))
    return state.select("gram", (F.col("length") + F.when(F.col("done"), 0.0).otherwise(F.log10(F.lit(SYMBOLS) - F.col("gone")))).alias("length"))


def lm_scores(docs: DataFrame, settings: PpmSettings | None = None, divisor: int = 7, held: int = 2) -> DataFrame:
    """Score every row of `docs` after learning from those whose crc32(doc_id) mod `divisor` is not `held`.

    Grams of `order` + 1 bytes and words are counted over all training texts;
    shorter contexts follow by grouping. Nothing is pruned: what is frequent is
    looked up in every task, and the distinct rarer grams and words of each text
    are joined with the full tables, so both scores are exact. Null
    texts are empty and consist of their end alone; with nothing to learn from,
    every byte costs log10(256). A null doc_id counts as the empty text in the split.
    """
    settings = settings or PpmSettings()
    rows = docs.select("doc_id", (crc_mod(F.col("doc_id"), divisor) == held).alias("held_out"), text_of().alias("text"))
    counted = rows.where("NOT held_out").select("text").mapInArrow(lean(gathered(settings.order)), "gram long, word binary, n long")
    counts = stage(counted.groupBy("gram", "word").agg(F.sum("n").alias("n")), "counts", tidy=True)
    words = counts.where("gram IS NULL").select("word", "n")
    seen = words.agg(F.sum("n").alias("tokens"), F.count("*").alias("distinct")).first()
    tokens, distinct = seen["tokens"] or 0, seen["distinct"]
    frequent = looked_up(words, tokens, settings.head, settings.most_words).toArrow()  # at most settings.most_words rows
    head = dict(zip(frequent["word"].to_pylist(), np.log10(frequent["n"].to_numpy() + 1.0).tolist(), strict=True))

    whole = counts.where("gram IS NOT NULL").agg(F.sum("n")).first()[0] or 0
    counts = counts.where("gram IS NOT NULL").select("gram", "n")
    lengths = stage(lengths_of(counts), "lengths", compression="zstd", tidy=True)
    often = looked_up(lengths, whole, settings.parts, settings.most_grams).select("gram", "length").toArrow()  # at most settings.most_grams rows
    codes = often["gram"].to_numpy().astype(np.uint64)
    at = np.argsort(codes)
    run = scorer(settings.order, codes[at], often["length"].to_numpy()[at], head)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(lean(run), f"doc_id {id_type}, held_out boolean, n_tokens long, known long, logs double, seen_score double, tail array<binary>, grams array<long>, times array<int>")
    scored = stage(scored.withColumn("row", F.monotonically_increasing_id()), "scored", compression="zstd", tidy=True)
    tails = scored.select("row", F.explode("tail").alias("word")).join(words, "word", "left")
    rare = tails.groupBy("row").agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1.0)).alias("more_logs"), F.count("n").alias("more_known"))
    pairs = scored.select("row", "held_out", F.explode(F.arrays_zip("grams", "times")).alias("pair")).select("row", "held_out", F.col("pair.grams").alias("gram"), F.col("pair.times").alias("times"))
    # Only texts that were held out can have grams that the counts do not have.
    novel = stage(pairs.where("held_out").select("gram").distinct().join(counts, "gram", "left_anti"), "novel", tidy=True)
    every = lengths.select("gram", "length").unionByName(novel_lengths(novel, counts, settings.order))
    tail_scores = pairs.join(every, "gram").groupBy("row").agg(F.sum(F.col("times") * F.col("length")).alias("tail_length"))
    score = F.col("seen_score") - F.coalesce("tail_length", F.lit(0.0))
    logs = F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(float(np.log10(tokens + distinct + 1)))
    return scored.drop("tail", "grams", "times").join(rare, "row", "left").join(tail_scores, "row", "left").select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"), logs.alias("base_score"), score.alias("score"))
