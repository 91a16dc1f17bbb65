"""Encoding and decoding with a merge-type piece model, by a table of each prefix's last token."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestry.llm.texts import text_of

SPACE = "▁"
# Units of text after which a worker starts a new memory, keeping the one before; results do not depend on it.
REMEMBERED = 300_000
# Pairs of tokens whose test a worker remembers.
PAIRS = 300_000
# Characters of text that a worker takes at once.
CHUNK = 1 << 20


class MergeModel:
    """What a merge-type model does with a text: always the best-ranked adjacent pair that makes a token, the left one of equals.

    Tokens are pieces of two and more characters and the characters of all
    pieces. A history is what merging makes of a token's own text; the token
    occurs in results only if it comes out as itself.
    """

    def __init__(self, pieces: list[str], scores: list[float], skipped: set[int]):
        self.pieces = list(pieces)
        self.id_of = {p: i for i, p in enumerate(pieces) if i not in skipped}
        self.n_pieces = len(pieces)
        for character in sorted({c for p in self.id_of for c in p}.difference(self.id_of)):
            self.id_of[character] = len(self.pieces)
            self.pieces.append(character)
        # Rank 0 is merged first; equal scores share a rank.
        rank = {s: r for r, s in enumerate(sorted({scores[i] for i in self.id_of.values() if i < self.n_pieces}, reverse=True))}
        self.rank_of = {p: rank[scores[i]] for p, i in self.id_of.items() if i < self.n_pieces and len(p) > 1}
        # For each token that occurs, its merges in order: (rank, last part after it) and (rank, first part after it).
        self.right: dict[str, list[tuple[int, str]]] = {}
        self.left: dict[str, list[tuple[int, str]]] = {}
        for piece in self.id_of:
            parts, right, left = self.history(piece)
            if parts == [piece]:
                self.right[piece], self.left[piece] = right, left

    def history(self, text: str) -> tuple[list[str], list[tuple[int, str]], list[tuple[int, str]]]:
        parts, right, left = list(text), [], []
        while True:
            best, at = None, 0
            for i in range(len(parts) - 1):
                rank = self.rank_of.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                return parts, right, left
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            right.append((best, parts[-1]))
            left.append((best, parts[0]))

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging the text a + b ends with exactly the tokens a and b.

        Both histories run side by side, the better-ranked next merge first, as
        they would in the joint text. At each state the parts that meet at the
        border must not be the pair that is merged next.
        """
        of_a, of_b = self.right[a], self.left[b]
        i = j = 0
        end, begin = a[-1], b[0]
        rank_of = self.rank_of
        while True:
            across = rank_of.get(end + begin)
            next_a = of_a[i][0] if i < len(of_a) else None
            next_b = of_b[j][0] if j < len(of_b) else None
            if across is not None and (next_a is None or across < next_a) and (next_b is None or across <= next_b):
                return False
            if next_a is not None and (next_b is None or next_a <= next_b):
                end = of_a[i][1]
                i += 1
            elif next_b is not None:
                begin = of_b[j][1]
                j += 1
            else:
                return True


def unit_pattern(tokens: Iterable[str]) -> re.Pattern:
    """Units of a normalised text, cut only where no token can reach across.

    White space that no token has stands alone. Unless a token has the space mark
    after another character, a unit begins at a run of marks; unless one has a
    letter beside anything else but a leading mark, letters end where other signs
    begin. Characters that no token has may fall into either part.
    """
    tokens = list(tokens)
    have = {c for t in tokens for c in t}
    alone = "".join(c for c in "\n\r\t\x0b\x0c" if c not in have)
    barrier = re.escape(alone)
    # The pattern's own letters include signs such as raised digits; those that tokens have count as other signs.
    signs = r"\W\d_" + re.escape("".join(sorted(c for c in have if re.match(r"[^\W\d_]", c) and not c.isalpha())))
    letter = re.compile(f"[^{signs}]")
    inside = any(SPACE in t.lstrip(SPACE) for t in tokens)
    mixed = any(len({bool(letter.match(c)) for c in t.lstrip(SPACE)}) > 1 for t in tokens)
    if inside:
        cut = f"[^{barrier}]+" if alone else "(?s:.)+"
    elif mixed:
        cut = f"{SPACE}*[^{SPACE}{barrier}]+|{SPACE}+"
    else:
        cut = f"{SPACE}*[^{signs}]+|{SPACE}*(?:(?![{SPACE}{barrier}])[{signs}])+|{SPACE}+"
    return re.compile(f"{cut}|[{barrier}]" if alone else cut)


class PieceCodec:
    """Ids of texts and back, as the sentencepiece library gives them for merge-type models with byte fallback.

    A text is cut where no token can reach across, and each distinct unit is
    encoded once by its prefix table.
    """

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        skipped = {i for i in range(n) if sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i)}
        byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(map(sp.is_byte, byte_ids)) or any(sp.is_unused(i) for i in range(n)):
            raise ValueError("only merge-type models with byte fallback and without unused pieces are encoded")
        self.bytes = np.array(byte_ids, np.int32)
        self.model = MergeModel(pieces, [sp.get_score(i) for i in range(n)], skipped)
        self.automaton = ahocorasick.Automaton()
        own = self.model.id_of
        for piece in self.model.right:
            self.automaton.add_word(piece, (own[piece], len(piece)))
        self.automaton.make_automaton()
        self.out = {own[p]: np.array([own[p]] if own[p] < n else self.bytes[list(p.encode())], np.int32).tobytes() for p in self.model.right}
        self.units = unit_pattern(own)
        # Whether normalising only turns spaces to marks and puts one in front; every character is tried.
        every = "".join(map(chr, [*range(1, 0xD800), *range(0xE000, 0x110000)])) + " \t  x  "
        self.plain = sp.normalize(every) == SPACE + every.replace(" ", SPACE) and not any(SPACE in p.lstrip(SPACE) for p in own)
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def compatible(self, a: int, b: int) -> bool:
        """Answers of the model's pair test, remembered for the pairs met lately."""
        key = a * len(self.model.pieces) + b
        answer = self.pairs.get(key)
        if answer is None:
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            answer = self.pairs[key] = self.model.compatible(self.model.pieces[a], self.model.pieces[b])
        return answer

    def last_tokens(self, unit: str) -> list[tuple[int, int] | None]:
        """For each prefix of the unit, id and length of the last token of its encoding; None where a character has no token.

        A token that ends a prefix is its last one exactly if it is compatible with
        the last token of what stands before it; no two tokens are.
        """
        table: list[tuple[int, int] | None] = [None] * len(unit)
        done = -1
        for end, token in self.automaton.iter(unit):
            if end == done:
                continue
            start = end - token[1]
            before = table[start] if start >= 0 else None
            if before is None or self.compatible(before[0], token[0]):
                table[end] = token
                done = end
        return table

    def encode_unit(self, unit: str) -> bytes:
        """Ids of a unit as 32-bit numbers, recovered from its end."""
        table, found, at = self.last_tokens(unit), [], len(unit) - 1
        while at >= 0:
            token = table[at]
            if token is None:
                found.append(self.bytes[list(unit[at].encode())].tobytes())
                at -= 1
            else:
                found.append(self.out[token[0]])
                at -= token[1]
        return b"".join(found[::-1])

    def unit_ids(self, unit: str) -> bytes:
        key = " " + unit  # no word has a space
        ids = self.known.get(key)
        if ids is None:
            ids = self.known[key] = self.older.get(key) or self.encode_unit(unit)
        return ids

    def learn(self, words: set[str]) -> None:
        """Ids of words with one space mark before them, kept under the words themselves; parts of words are kept apart."""
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        for word in words.difference(self.known):
            ids = self.older.get(word)
            if ids is None:
                units = self.units.findall(SPACE + word)
                ids = self.encode_unit(units[0]) if len(units) == 1 else b"".join(map(self.unit_ids, units))
            self.known[word] = ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of the texts. Where each space is one unit's start, a split at spaces already gives the words."""
        listed: list[list[str] | None] = [text.split(" ") if self.is_spaced(text) else None for text in texts]
        self.learn(set().union(*filter(None, listed)))
        return [
            b"".join(map(self.known.__getitem__, words)) if words else b"".join(map(self.unit_ids, self.units.findall(self.library.normalize(text))))
            for words, text in zip(listed, texts, strict=True)
        ]

    def is_spaced(self, text: str) -> bool:
        return self.plain and text != "" and "  " not in text and text[0] != " " != text[-1] and SPACE not in text

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@lru_cache(maxsize=1)
def worker_codec(path: str) -> PieceCodec:
    """One for all tasks that a Python worker runs."""
    return PieceCodec(path)


def chunks(texts: list[str]) -> Iterator[list[str]]:
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def coder(path: str, decode: bool):
    """Batches of (doc_id, text) to (doc_id, ids) and, if asked, the text that the ids decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(path)
        for batch in batches:
            at = 0
            for texts in chunks(batch.column("text").to_pylist()):
                coded = [np.frombuffer(b, np.int32) for b in codec.encode(texts)]
                offsets = np.cumsum([0, *map(len, coded)], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(coded)))
                columns = [batch.column("doc_id").slice(at, len(texts)), ids]
                if decode:
                    columns.append(pa.array([codec.decode(x.tolist()) for x in coded], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][: len(columns)])
                at += len(texts)

    return run


def encode_texts(docs: DataFrame, path: str, decode: bool = False) -> DataFrame:
    """doc_id and `ids` of every whole text; with `decode` also `decoded`, the text that the ids give back.

    One row for each row of `docs`, repeated rows and ids included; null texts are
    empty and have no ids; other columns are left aside. Characters outside the
    vocabulary become one id for each byte. A unit without white space is encoded
    in time proportional to its length, however long. Rows are independent: no
    shuffle, and a lost task is simply run again.
    """
    rows = docs.select("doc_id", text_of().alias("text"))
    kind = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>"
    return rows.mapInArrow(coder(path, decode), f"{kind}, decoded string" if decode else kind)


def decode_ids(coded: DataFrame, path: str) -> DataFrame:
    """doc_id and `decoded` from the columns doc_id and ids, as stored; null ids decode to an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(path)
        for batch in batches:
            texts = [codec.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "decoded"])

    rows = coded.select("doc_id", "ids")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, decoded string")


def piece_digest(docs: DataFrame, path: str) -> DataFrame:
    """Number of ids of every document, and digests of the ids and of the text decoded from them."""
    coded = encode_texts(docs, path, decode=True)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
