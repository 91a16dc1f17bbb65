"""Secret scans: single credentials, and parts of one that only count together."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestry.llm.texts import text_of
from digestry.session import stage

# Fixed values of the base scan, in the order in which they are listed.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
BASE_KINDS = ("assign", "access", "hex")

# Weak parts, by role.
NAMED = re.compile(r"""(?ai:user(?:name|_?id)?|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@+-]{3,})""")
ADDRESS = re.compile(r"""(?ai:https?|ftps?|wss?|jdbc:\w+|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqps?|s3)://[^\s"'<>|]{3,}""")
HOST = re.compile(r"""(?ai:host(?:name)?|endpoint|server|base_?url)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._:/-]{3,})""")
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}")
SHORT = re.compile(r"""(?ai:pass(?:word|wd|phrase)?|pwd|secret|token|api_?key|private_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=!@#$%^&*-]{4,})""")
LINKED_KINDS = ("identifier", "endpoint", "value")
KINDS = BASE_KINDS + LINKED_KINDS

# What a part needs near it to be reported, and what a base finding stands for.
ROLE = {"assign": "value", "hex": "value", "value": "value", "access": "identifier", "identifier": "identifier", "endpoint": "endpoint"}
REACH = 240
MIN_BITS = 3.5


def spread(text: str) -> float:
    """Bits per character of a string by its own character counts."""
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def opaque(text: str) -> bool:
    """Letters of both cases and digits, evenly used: what random keys look like and words do not."""
    classes = (any(c.islower() for c in text), any(c.isupper() for c in text), any(c.isdigit() for c in text))
    return all(classes) and spread(text) >= MIN_BITS


def parts_of(text: str) -> list[tuple[str, int, int]]:
    """All parts (kind, start, end) in code points, base kinds first.

    A part of a linked kind that touches a base finding is left out, as are
    overlaps within a kind. A pattern is tried wherever its own characters occur;
    opaque values are left out only in texts without any other part, where
    nothing could link them.
    """
    base = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    base += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    base += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    weak = []
    if ":" in text or "=" in text:
        weak += [("identifier", m.start(), m.end()) for m in NAMED.finditer(text)]
        weak += [("endpoint", m.start(), m.end()) for m in HOST.finditer(text)]
        weak += [("value", m.start(), m.end()) for m in SHORT.finditer(text)]
    if "://" in text:
        weak += [("endpoint", m.start(), m.end()) for m in ADDRESS.finditer(text)]
    if weak or base:
        weak += [("value", m.start(), m.end()) for m in OPAQUE.finditer(text) if opaque(m.group())]
    weak.sort(key=lambda part: (part[0], part[1], -part[2]))
    taken = sorted((start, end) for _, start, end in base)
    kept, last, at = [], {}, {}
    for kind, start, end in weak:
        i = at.get(kind, 0)
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        at[kind] = i
        if start >= last.get(kind, 0) and not (i < len(taken) and taken[i][0] < end):
            kept.append((kind, start, end))
            last[kind] = end
    return base + kept


def blocks_before(text: str, starts: list[int]) -> list[int]:
    """For each place, how many empty lines stand before it: parts in different blocks are in different scopes."""
    breaks = [m.end() for m in re.finditer(r"\n[\x20\t]*\n", text)]
    found, at, by_place = 0, 0, {}
    for place in sorted(set(starts)):
        while at < len(breaks) and breaks[at] <= place:
            at += 1
            found += 1
        by_place[place] = found
    return [by_place[place] for place in starts]


PARTS = "array<struct<kind: string, start: int, end: int, block: int>>"


def finder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("block", pa.int32())]))
    for batch in batches:
        found = []
        for text in batch.column("text").to_pylist():
            parts = parts_of(text)
            blocks = blocks_before(text, [start for _, start, _ in parts]) if parts else []
            found.append([{"kind": k, "start": s, "end": e, "block": b} for (k, s, e), b in zip(parts, blocks, strict=True)])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], ["doc_id", "parts"])


def find_parts(docs: DataFrame) -> DataFrame:
    """doc_id, row (a number for each input row) and parts, written once."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_of().alias("text")).mapInArrow(finder, f"doc_id {id_type}, parts {PARTS}")
    return stage(rows.withColumn("row", F.monotonically_increasing_id()), "parts")


def role_of(kind: Column) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for pair in ROLE.items() for x in pair)), kind)


def link_parts(found: DataFrame, reach: int = REACH) -> DataFrame:
    """Weak parts (row, kind, start, end, partners) that a complementary part stands near.

    Values need an identifier or an endpoint, identifiers and endpoints need a
    value, in the same block of the same text with at most `reach` characters
    between. The intervals meet in an equi-join: a weak part is sent to the bins
    of `reach` characters that its surroundings touch, a partner to the bin of
    its start and to each bin it runs through. A bin holds so few parts of one
    text that a text full of credentials costs in proportion to its length.
    """
    parts = found.select("row", F.inline("parts")).withColumn("role", role_of(F.col("kind")))
    bins = lambda low, high: F.explode(F.sequence(F.floor(low / reach), F.floor(high / reach)))
    weak = parts.where(F.col("kind").isin(*LINKED_KINDS)).withColumn("bin", bins(F.greatest(F.col("start") - reach, F.lit(0)), F.col("end") + reach))
    near = parts.select("row", F.col("block"), F.col("role").alias("_role"), F.col("start").alias("_start"), F.col("end").alias("_end"), bins(F.col("start"), F.col("end")).alias("bin"))
    fits = (F.col("_start") <= F.col("end") + reach) & (F.col("start") <= F.col("_end") + reach)
    complementary = (F.col("role") == "value") != (F.col("_role") == "value")
    return weak.join(near, ["row", "block", "bin"]).where(fits & complementary).groupBy("row", "kind", "start", "end").agg(F.countDistinct("_start", "_end").alias("partners"))


def joined_spans(spans: Column) -> Column:
    """kind:start:end by start, then kind in the order of KINDS, comma-joined."""
    ranked = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.array_position(F.array(*(F.lit(k) for k in KINDS)), s["kind"]).alias("place"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(ranked, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def credential_report(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row for each document with its spans; a null text is empty, a text without any finding has empty lists.

    `base` and `linked` are arrays of (kind, start, end) in code points. Rows that
    are equal, or share a doc_id, are each judged by their own text.
    """
    found = find_parts(docs)
    linked = link_parts(found, reach).groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end", "partners")).alias("linked"))
    base = F.transform(F.filter("parts", lambda p: p["kind"].isin(*BASE_KINDS)), lambda p: F.struct(p["kind"].alias("kind"), p["start"].alias("start"), p["end"].alias("end")))
    empty = F.array().cast("array<struct<kind: string, start: int, end: int, partners: bigint>>")
    return found.join(linked, "row", "left").select("doc_id", base.alias("base"), F.coalesce("linked", empty).alias("linked"))


def credential_digest(docs: DataFrame, reach: int = REACH) -> DataFrame:
    report = credential_report(docs, reach)
    plain = F.transform("linked", lambda p: F.struct(p["kind"].alias("kind"), p["start"].alias("start"), p["end"].alias("end")))
    count = lambda kind: F.size(F.filter("base", lambda p: p["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return report.select(
        "doc_id",
        *(count(kind) for kind in BASE_KINDS),
        F.sha2(joined_spans(F.col("base")), 256).alias("base_sha256"),
        joined_spans(F.concat("base", plain)).alias("spans"),
        F.size("linked").cast("long").alias("n_linked"),
    )
