"""Token ids in files: frequency ranks in byte-aligned variable-length coding with separate control bytes."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from digestry.llm.lean import lean
from digestry.llm.texts import text_of
from digestry.session import scratch_path, stage

END_ID = 1
# A block is closed at the first document end past so many ids.
BLOCK_IDS = 1 << 18
# Encoded pieces of text after which a worker starts a new memory, keeping the one before; results do not depend on it.
# A job that has its workers to itself can remember more, some 170 bytes a piece.
REMEMBERED = 300_000
REMEMBERED_ALONE = 1_000_000

# For each control byte, which of the 16 bytes of four numbers are stored: two bits a number, bytes less one.
STORED = np.array([[byte <= (control >> 2 * number) & 3 for number in range(4) for byte in range(4)] for control in range(256)])


def encode_numbers(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes (two bits for each number) and data bytes (1 to 4 for each) of unsigned 32-bit numbers."""
    padded = np.zeros(-(-len(numbers) // 4) * 4, "<u4")
    padded[: len(numbers)] = numbers
    codes = ((padded > 0xFF).astype(np.uint8) + (padded > 0xFFFF) + (padded > 0xFFFFFF)).reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    return control.tobytes(), padded.view(np.uint8).reshape(-1, 16)[STORED[control]].tobytes()


def decode_numbers(control: bytes, data: bytes, count: int) -> np.ndarray:
    """Inverse of `encode_numbers`: one table lookup tells where the bytes of four numbers go."""
    control_bytes = np.frombuffer(control, np.uint8)
    spread = np.zeros((len(control_bytes), 16), np.uint8)
    spread[STORED[control_bytes]] = np.frombuffer(data, np.uint8)
    return spread.view("<u4").ravel()[:count]


# What stands between ASCII white space; and, for texts within Latin-1, runs of letters and runs of anything else.
PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
LETTER_RUNS = re.compile(r"[a-zªµºß-öø-ÿ]+|[^a-zªµºß-öø-ÿ\x20\x09-\x0D]+")
# Words of letters that are encoded by one call.
JOINED = 256


def within_latin1(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class PieceEncoder:
    """Ids of whole texts from the ids of their pieces, each piece encoded once.

    The vocabulary's own splitting never joins what white space separates, nor a
    letter with a sign; only an apostrophe before certain letters does the latter,
    so texts with one are cut at white space alone, as are texts beyond Latin-1,
    where normalising could join signs. Words of letters go to the tokenizer many
    at a time: each ends with the one id of its word that marks a word's end. Texts
    that hold an added token, such as the end-of-text mark, go to the tokenizer
    whole, which gives that token its own id.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.added_start = os.path.commonprefix(self.added)
        vocabulary = self.tokenizer.get_vocab()
        self.kind = id_kind(self.tokenizer)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.remembered = remembered
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        if "'" in text or not within_latin1(text):
            return PLAIN.findall(text)
        return LETTER_RUNS.findall(text.lower())

    def learn(self, listed: list[list[str]]) -> None:
        if len(self.known) > self.remembered:
            self.known, self.older = {}, self.known
        new = set().union(*listed).difference(self.known)
        again = new.intersection(self.older)
        self.known.update((p, self.older[p]) for p in again)
        new -= again
        words = [p for p in new if p[0].isalpha() and LETTER_RUNS.fullmatch(p)]
        single = new.difference(words)
        for at in range(0, len(words), JOINED):
            own = words[at : at + JOINED]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(own)], add_special_tokens=False)[0].ids, self.kind)
            ends = ((np.flatnonzero(self.ends_word[ids]) + 1) * ids.itemsize).tolist()
            if len(ends) == len(own):
                raw = ids.tobytes()
                self.known.update(zip(own, (raw[i:j] for i, j in zip([0, *ends], ends)), strict=True))
            else:
                single.update(own)
        single_ones = sorted(single)
        for piece, coded in zip(single_ones, self.tokenizer.encode_batch_fast(single_ones, add_special_tokens=False), strict=True):
            self.known[piece] = np.array(coded.ids, self.kind).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        listed = [None if self.has_added(text) else self.pieces(text) for text in texts]
        self.learn([pieces for pieces in listed if pieces])
        return [self.whole(text) if pieces is None else b"".join(map(self.known.__getitem__, pieces)) for text, pieces in zip(texts, listed, strict=True)]

    def has_added(self, text: str) -> bool:
        """Whether one of the vocabulary's added tokens stands in the text; the library finds those ahead of anything else."""
        return self.added_start in text and any(token in text for token in self.added)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()


@lru_cache(maxsize=1)
def worker_encoder(path: str, remembered: int) -> PieceEncoder:
    """One for all tasks that a Python worker runs."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
    return PieceEncoder(path, remembered)


def id_kind(tokenizer) -> str:
    """Two bytes for each id where the vocabulary allows, else four; only inside the job, files have their own coding."""
    return "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"


def encoder(tokenizer_path: str, end_id: int, remembered: int):
    """Batches of (doc_id, tie, text) to (doc_id, tie, ids as little-endian numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = worker_encoder(tokenizer_path, remembered)
        end = np.array([end_id], own.kind).tobytes()
        for batch in batches:
            ids = [x + end for x in own.encode(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tie"), pa.array(ids, pa.binary())], ["doc_id", "tie", "ids"])

    return run


def id_counter(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(np.frombuffer(b"".join(batch.column("ids").to_pylist()), kind))
            if len(found) > len(totals):
                totals = np.pad(totals, (0, len(found) - len(totals)))
            totals[: len(found)] += found
        there = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(totals[there], pa.int64())], ["id", "n"])

    return run


def packer(rank_of: np.ndarray, kind: str, block_ids: int):
    """Sorted documents of one range to blocks; `first` counts the ids of the range before a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, first = TaskContext.get().partitionId(), 0
        docs: list = []
        held: list[np.ndarray] = []
        size = 0

        def block():
            control, data = encode_numbers(rank_of[np.concatenate(held)])
            return pa.RecordBatch.from_pylist([{"part": part, "first": first, "n": size, "doc_ids": docs, "counts": [len(x) for x in held], "control": control, "data": data}], schema=BLOCK)

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                docs.append(doc_id)
                held.append(np.frombuffer(ids, kind))
                size += len(held[-1])
                if size >= block_ids:
                    yield block()
                    first, docs, held, size = first + size, [], [], 0
        if docs:
            yield block()

    return run


BLOCK = pa.schema([("part", pa.int32()), ("first", pa.int64()), ("n", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("control", pa.binary()), ("data", pa.binary())])
BLOCK_TYPE = "part int, first long, n long, doc_ids array<long>, counts array<long>, control binary, data binary"


def write_token_files(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS, remembered: int = REMEMBERED) -> None:
    """Encode every text and write the ids below `path`, documents in ascending doc_id order.

    `ranks` has the ids by frequency over the whole corpus, one row for each id
    that occurs: at most the vocabulary, which bounds what the driver and the
    tasks hold of it. `blocks` has a row of control bytes and data bytes for some
    hundred thousand ids, with the documents they belong to. Both go through
    Spark's own committed writer, so a task that is lost and run again leaves no
    half file and nothing twice. Null texts are empty, null ids come first, equal
    ids are ordered by a hash of the text, and equal rows are all kept.
    """
    from tokenizers import Tokenizer

    spark, kind = docs.sparkSession, id_kind(Tokenizer.from_file(tokenizer_path))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), text_of().alias("text"))
    coded = stage(rows.mapInArrow(lean(encoder(tokenizer_path, end_id, remembered)), "doc_id long, tie long, ids binary"), "ids", compression="zstd")
    counts = coded.select("ids").mapInArrow(lean(id_counter(kind)), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    ranked = counts.sort_values(["n", "id"], ascending=[False, True])["id"].to_numpy(np.int64)
    spark.createDataFrame([(rank, int(token)) for rank, token in enumerate(ranked)], "rank long, id long").write.parquet(f"{path}/ranks")
    rank_of = np.zeros(int(ranked.max(initial=0)) + 1, np.uint32)
    rank_of[ranked] = np.arange(len(ranked), dtype=np.uint32)
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    sorted_rows = coded.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids")
    sorted_rows.mapInArrow(lean(packer(rank_of, kind, block_ids)), BLOCK_TYPE).write.option("compression", "zstd").parquet(f"{path}/blocks")


def unpacker(id_of: np.ndarray, digest: bool):
    """Blocks to documents, each with its ids or with their checksum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                ids = id_of[decode_numbers(block["control"], block["data"], block["n"])]
                counts = np.array(block["counts"], np.int64)
                ends = np.cumsum(counts)
                each = [x.tobytes() for x in np.split(ids, ends[:-1])]
                last = pa.array([zlib.crc32(x) for x in each], pa.int64()) if digest else pa.array(each, pa.binary())
                part = pa.array([block["part"]] * len(each), pa.int32())
                yield pa.RecordBatch.from_arrays([part, pa.array(block["doc_ids"], pa.int64()), pa.array(block["first"] + ends - counts), pa.array(counts), last], ["part", "doc_id", "inside", "n_tokens", "last"])

    return run


def read_token_files(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian numbers) from the files.

    With `digest`, ids_crc32 (checksum of the ids) stands in place of the ids.
    """
    ranks = spark.read.parquet(f"{path}/ranks").toPandas().sort_values("rank")  # at most the vocabulary
    blocks = spark.read.schema(BLOCK_TYPE).parquet(f"{path}/blocks")
    kind, name = ("long", "ids_crc32") if digest else ("binary", "ids")
    docs = blocks.mapInArrow(lean(unpacker(ranks["id"].to_numpy("<u4"), digest)), f"part int, doc_id long, inside long, n_tokens long, last {kind}")
    # One row for each range that was written.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = blocks.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))
    return docs.join(F.broadcast(ahead), "part").select("doc_id", (F.col("ahead") + F.col("inside")).alias("start"), "n_tokens", F.col("last").alias(name))


def token_digest(docs: DataFrame, tokenizer_path: str, path: str | None = None, remembered: int = REMEMBERED) -> DataFrame:
    """Write the files, read them back and return doc_id, start, n_tokens and the checksum of the ids."""
    path = path or scratch_path(docs.sparkSession, "tokens")
    write_token_files(docs, tokenizer_path, path, remembered=remembered)
    return read_token_files(docs.sparkSession, path, digest=True)
