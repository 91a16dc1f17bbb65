"""Near duplicates: banded MinHash candidates, verified step by step with Bayesian bounds and then exactly."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from digestry.llm.graph_parts import components
from digestry.llm.lean import lean
from digestry.llm.texts import text_of
from digestry.session import stage

# Shingles of long texts meet the hash functions in pieces of this many.
PIECE = 2048
# Words of texts with as many bytes together are hashed at once.
HASHED = 1 << 20
# Members of a bucket that are compared with each other at once.
BLOCK = 256


@dataclass(frozen=True)
class NearSettings:
    """`width` words make a shingle; sets are linked from `percent` of similarity on.

    Bands take the first rows * bands of the `hashes`; a link is missed by all of
    them with probability (1 - 0.8 ** rows) ** bands, 5e-6 here. Signatures are
    compared in steps of `step` hashes, and at each step a pair is dropped if its
    chance to be a link is below `miss`.
    """

    width: int = 4
    percent: int = 80
    rows: int = 6
    bands: int = 40
    hashes: int = 384
    step: int = 48
    miss: float = 1e-4
    rounds: int = 2


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """Per text, the sorted distinct shingles as 64-bit hashes; A-Z lowered, words between ASCII white space."""
    sets, words, size = [], [], 0
    for text in texts:
        lowered = text.encode().lower()
        words.append(lowered.split())
        size += len(lowered)
        if size > HASHED:
            sets += hashed_sets(words, width)
            words, size = [], 0
    return sets + hashed_sets(words, width)


def hashed_sets(words: list[list[bytes]], width: int) -> list[np.ndarray]:
    flat = [w for each in words for w in each]
    hashes = pd.util.hash_array(np.array(flat, dtype=object), categorize=False) if flat else np.zeros(0, np.uint64)
    sets, at = [], 0
    for each in words:
        own, n = hashes[at : at + len(each)], min(width, len(each))
        at += len(each)
        if not n:
            sets.append(np.zeros(0, np.uint64))
            continue
        joined = np.full(len(own) - n + 1, n, np.uint64)
        for k in range(n):
            joined = mixed(joined + own[k : k + len(joined)])
        sets.append(np.unique(joined))
    return sets


def hash_functions(count: int) -> np.ndarray:
    return np.random.default_rng(7).integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """Smallest value of each hash function over a set."""
    least = np.full(len(odd), np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), PIECE):
        np.minimum(least, (shingles[at : at + PIECE, None] * odd).min(axis=0), out=least)
    return least


def summarizer(settings: NearSettings):
    """Texts to set size, a 128-bit key of the set, one byte of each minimum, and one hash for each band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd = hash_functions(settings.hashes)
        for batch in batches:
            sets = shingle_sets(batch.column("text").to_pylist(), settings.width)
            keys, signs, bands = [], [], []
            for own in sets:
                keys.append(set_key(own))
                if not len(own):
                    signs.append(b"")
                    bands.append([])
                    continue
                least = mixed(signature(own, odd))
                signs.append((least >> np.uint64(56)).astype(np.uint8).tobytes())
                code = np.arange(settings.bands, dtype=np.uint64)
                for row in least[: settings.rows * settings.bands].reshape(settings.rows, settings.bands):
                    code = mixed(code + row)
                bands.append(code.view(np.int64))
            sizes = pa.array([len(x) for x in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes, pa.array(keys, pa.binary()), pa.array(signs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "n", "key", "sign", "bands"])

    return run


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def keyed_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column("text").to_pylist(), width)
            yield pa.RecordBatch.from_arrays([pa.array([set_key(x) for x in sets], pa.binary()), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))], ["key", "shingles"])

    return run


def least_matches(settings: NearSettings) -> list[tuple[int, int]]:
    """(hashes compared, matches needed) for each step.

    With a uniform prior, the similarity after m matches of n follows
    Beta(m + 1, n - m + 1), and the chance that it is t or more is that of at most
    m successes in n + 1 trials at t. A pair is dropped where that chance is below
    `miss`. A byte of a minimum matches by chance once in 256, which is added to t.
    """
    similar = settings.percent / 100
    t = similar + (1 - similar) / 256
    table = []
    for n in range(settings.step, settings.hashes + 1, settings.step):
        chance, needed = 0.0, 0
        for m in range(n + 1):
            chance += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if chance >= settings.miss:
                break
            needed = m + 1
        table.append((n, needed))
    return table


def passing(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray, table: list[tuple[int, int]]) -> np.ndarray:
    """Which of the pairs (left[a], right[b]) of signatures pass every step; later steps see only what passed."""
    alive, matches, done = np.arange(len(a)), np.zeros(len(a), np.int64), 0
    for n, needed in table:
        matches = matches + (left[a[alive], done:n] == right[b[alive], done:n]).sum(axis=1)
        passed = matches >= needed
        alive, matches, done = alive[passed], matches[passed], n
    return alive


def signatures(column, length: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, length)


def pruner(settings: NearSettings):
    """Keep the pairs whose signatures pass."""
    table = least_matches(settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length = settings.hashes
        for batch in batches:
            own = np.arange(batch.num_rows)
            alive = passing(signatures(batch.column("sign_a"), length), signatures(batch.column("sign_b"), length), own, own, table)
            yield batch.take(pa.array(alive)).select(["a", "b"])

    return run


def block_pruner(settings: NearSettings):
    """Two blocks of members of a bucket to the pairs across components whose signatures pass."""
    table = least_matches(settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length = settings.hashes
        for batch in batches:
            for row in range(batch.num_rows):
                sides = [batch.column(side)[row].values for side in ("left", "right")]
                band, same = (batch.column(c)[row].as_py() for c in ("band", "same"))
                (node, root, n), (node_b, root_b, n_b) = ([side.field(c).to_numpy(zero_copy_only=False) for c in ("node", "root", "n")] for side in sides)
                left, right = (signatures(side.field("sign"), length) for side in sides)
                codes, codes_b = (side.field("bands").flatten().to_numpy(zero_copy_only=False).reshape(-1, settings.bands) for side in sides)
                for at in range(len(node)):
                    near = np.minimum(n[at], n_b) * 100 >= np.maximum(n[at], n_b) * settings.percent
                    once = (node[at] < node_b) | (not same)
                    others = np.flatnonzero(near & once & (root[at] != root_b))
                    alive = passing(left, right, np.full(len(others), at), others, table)
                    # A pair that shares several buckets is reported from the first. Only whole band codes tell which one that
                    # is: bytes of minima also agree by chance, in bands whose bucket the two do not share.
                    alive = alive[(codes[at] == codes_b[others[alive]]).argmax(axis=1) == band]
                    if len(alive):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(alive), node[at])), pa.array(node_b[others[alive]])], ["a", "b"])

    return run


def one_way(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


class NearSets:
    """Distinct shingle sets of `docs`, and links between them.

    `docs_sets` has a row for each input row: doc_id, n (set size), node. `nodes`
    has a row for each distinct set that is not empty: node, key, doc (its
    smallest doc_id), copies, n. Equal sets are one node, so exact copies cost
    nothing beyond the first grouping, however many there are.
    """

    def __init__(self, docs: DataFrame, settings: NearSettings | None = None):
        self.settings = settings or NearSettings()
        self.spark = docs.sparkSession
        self.texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
        schema = "doc_id long, n long, key binary, sign binary, bands array<long>"
        self.rows = stage(self.texts.mapInArrow(lean(summarizer(self.settings)), schema), "signatures")
        own = self.rows.where("n > 0")
        grouped = own.groupBy("key").agg(F.min("doc_id").alias("doc"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("sign").alias("sign"), F.first("bands").alias("bands"))
        self.nodes = stage(grouped.withColumn("node", F.monotonically_increasing_id()), "nodes")
        exploded = self.nodes.select("node", "n", "copies", F.posexplode("bands").alias("band", "bucket"))
        # A bucket of one node has no pair.
        shared = exploded.groupBy("bucket").agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
        self.buckets = stage(exploded.join(shared, "bucket"), "buckets")

    def near_size(self, a: str, b: str):
        """Sets that differ more in size than the similarity allows cannot be linked."""
        return F.least(a, b) * 100 >= F.greatest(a, b) * self.settings.percent

    def pruned(self, pairs: DataFrame) -> DataFrame:
        """Of (a, b) pairs of nodes, those whose signatures pass."""
        pairs = stage(one_way(pairs), "pairs")
        signs = self.nodes.select("node", "sign")
        signed = pairs.join(signs.select(F.col("node").alias("a"), F.col("sign").alias("sign_a")), "a").join(signs.select(F.col("node").alias("b"), F.col("sign").alias("sign_b")), "b")
        return signed.mapInArrow(lean(pruner(self.settings)), "a long, b long")

    def pruned_blocks(self, members: DataFrame) -> DataFrame:
        """Of all members of a bucket that are in different components, the pairs whose signatures pass.

        Members are packed into blocks of about BLOCK and blocks meet blocks, so a
        pair becomes a row only if it passes and a task holds two blocks at a time.
        Each pair of blocks has a key of its own on both sides, so the pairs of a
        large bucket are spread over all tasks from the start.
        """
        counts = members.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
        placed = members.join(counts, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))).join(self.nodes.select("node", "sign", "bands"), "node")
        packed = stage(placed.groupBy("bucket", "band", "block", "blocks").agg(F.collect_list(F.struct("node", "root", "n", "sign", "bands")).alias("left")), "blocks")
        low = packed.select("bucket", "band", F.col("block").alias("low"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("high"), "left")
        high = packed.select("bucket", F.explode(F.sequence(F.lit(0).cast("long"), "block")).alias("low"), F.col("block").alias("high"), F.col("left").alias("right"))
        met = low.join(high, ["bucket", "low", "high"]).select("band", F.expr("low = high").alias("same"), "left", "right")
        return met.mapInArrow(lean(block_pruner(self.settings)), "a long, b long")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Of (a, b) pairs of nodes, those whose whole sets are similar enough."""
        alive = stage(one_way(pairs), "alive")
        wanted = alive.select(F.col("a").alias("node")).unionByName(alive.select(F.col("b").alias("node"))).distinct()
        wanted = stage(wanted.join(self.nodes.select("node", "key", "doc"), "node"), "wanted")
        # Written, so that the planner joins by its real size.
        ids = stage(wanted.select("doc").distinct(), "ids")
        held = self.texts.join(ids, self.texts["doc_id"].eqNullSafe(ids["doc"]), "left_semi")
        sets = held.select("text").mapInArrow(lean(keyed_sets(self.settings.width)), "key binary, shingles array<long>")
        sets = stage(sets.join(wanted.select("node", "key"), "key").dropDuplicates(["node"]).select("node", "shingles"), "sets")
        both = alive.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a")), "a").join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b")), "b")
        counted = both.select("a", "b", F.size(F.array_intersect("of_a", "of_b")).alias("_common"), (F.size("of_a") + F.size("of_b")).alias("_all"))
        return stage(counted.where(F.col("_common") * 100 >= (F.col("_all") - F.col("_common")) * self.settings.percent).select("a", "b"), "links")

    def rooted(self, links: DataFrame) -> DataFrame:
        """Buckets with the component so far of each member."""
        parts = stage(components(links), "roots")
        with_root = self.buckets.join(parts, self.buckets["node"] == parts["node"], "left").select(self.buckets["*"], F.coalesce(parts["root"], self.buckets["node"]).alias("root"))
        # What is one component already has nothing left to compare.
        open_ones = with_root.groupBy("bucket").agg(F.min("root").alias("_low"), F.max("root").alias("_high")).where("_low < _high").select("bucket")
        return stage(with_root.join(open_ones, "bucket"), "open")

    def against_leader(self, members: DataFrame, choice) -> DataFrame:
        """Every member of a bucket with the one that comes first by `choice`, where they are not yet together."""
        leaders = members.groupBy("bucket").agg(F.min(F.struct(choice.alias("c"), "node", "n", "root")).alias("first"))
        first = leaders.select("bucket", F.col("first.node").alias("b"), F.col("first.n").alias("_n"), F.col("first.root").alias("_root"))
        return members.join(first, "bucket").where((F.col("root") != F.col("_root")) & self.near_size("n", "_n")).select(F.col("node").alias("a"), "b")

    def links(self) -> DataFrame:
        """Links (a, b) of nodes that give the components of all links.

        Comparing all members of a bucket with each other would cost the square of
        its size. Instead each round compares the members with one of them, first
        with the set that has most copies, then with one drawn for each bucket, and
        joins what is linked. What remains are members of one bucket that are in
        different components after all rounds; those pairs are all compared, so no
        pair that the bands propose is left open.
        """
        members = self.buckets.withColumn("root", F.col("node"))
        found = self.confirmed(self.pruned(self.against_leader(members, -F.col("copies"))))
        for turn in range(1, self.settings.rounds):
            found = found.unionByName(self.confirmed(self.pruned(self.against_leader(self.rooted(found), F.xxhash64("node", "bucket", F.lit(turn))))))
        return found.unionByName(self.confirmed(self.pruned_blocks(self.rooted(found))))

    def placed(self) -> DataFrame:
        """doc_id, n, key, root and component_id for every input row; a row without shingles has no root."""
        parts = components(self.links())
        named = self.nodes.select("node", "key", "doc").join(parts, "node", "left").withColumn("root", F.coalesce("root", "node"))
        smallest = named.groupBy("root").agg(F.min("doc").alias("component_id"))
        of_key = named.join(smallest, "root").select("key", "root", "component_id")
        rows = self.rows.select("doc_id", "n", "key").join(of_key, "key", "left")
        component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
        return rows.select("doc_id", "n", "key", "root", component.alias("component_id"))

    def classes(self) -> DataFrame:
        """doc_id, n_shingles, component_id and kept for every input row."""
        return self.placed().select("doc_id", F.col("n").alias("n_shingles"), "component_id", is_first().alias("kept"))


def is_first() -> Column:
    return F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))


def with_set_key(rows: DataFrame, out: str, settings: NearSettings | None = None) -> DataFrame:
    """Add `out`: the key of the row's shingle set, null for a set without shingles."""
    width = (settings or NearSettings()).width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets([text or "" for text in batch.column("text").to_pylist()], width)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([set_key(x) if len(x) else None for x in sets], pa.binary())], [*batch.schema.names, out])

    return rows.mapInArrow(lean(run), StructType([*rows.schema.fields, StructField(out, BinaryType())]))


def near_duplicates(docs: DataFrame, settings: NearSettings | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links) and kept (it is that one).

    Null and empty texts, and texts of white space, have no shingles and stand
    alone; texts of fewer words than a shingle are one shingle. Equal sets are
    linked. Rows that repeat a doc_id are judged each by its own text; where the
    first doc_id of a component is repeated in it, all those rows are kept. A row
    without doc_id is never first while its component has an id, and is not kept.
    """
    return NearSets(docs, settings).classes()
