"""License scans: notices found by exact seeds and verified with a bounded number of edits."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestry.llm.texts import text_of
from digestry.session import stage

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# Fixed values of the base scan.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Short notices of public licenses, as words in lower case.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license version 2 0": "apache",
    "you may not use this file except in compliance with the license": "apache",
    "licensed under the gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms": "bsd",
    "released under the bsd license": "bsd",
    "released under the isc license": "isc",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "mozilla public license version 2 0": "mpl",
    "eclipse public license": "epl",
    "licensed under cc by": "cc-by",
    "licensed under cc by sa": "cc-by-sa",
    "licensed under cc by nd": "cc-by-nd",
    "licensed under cc by nc": "cc-by-nc",
    "licensed under cc by nc sa": "cc-by-nc-sa",
    "licensed under cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by",
    "this is free and unencumbered software released into the public domain": "unlicense",
}

# Words that tell one license from another. A notice matches only where its own ones stand; a slip of one
# letter is forgiven unless it makes the word of another license.
NAMES = frozenset("mit apache gnu lesser affero bsd isc mozilla eclipse epl mpl gpl lgpl agpl cc by sa nd nc zlib unencumbered".split())


@dataclass(frozen=True)
class LicenseSettings:
    """One edit is allowed for every `per_edit` characters of a notice, and at least one."""

    per_edit: int = 8


def edits_for(notice: str, settings: LicenseSettings) -> int:
    return max(1, len(notice) // settings.per_edit)


def one_edit(a: str, b: str) -> bool:
    """Whether two words are equal up to one inserted, dropped or changed letter."""
    if abs(len(a) - len(b)) > 1:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[same + 1 :] == b[same + 1 :] or a[same + 1 :] == b[same:] or a[same:] == b[same + 1 :]


def names_stand(notice: str, matched: str) -> bool:
    """Whether the words that name the license stand in a matched text, in their order."""
    own, words = [w for w in notice.split() if w in NAMES], iter(matched.split())
    return all(any(w == name or (w not in NAMES and len(name) > 2 and one_edit(w, name)) for w in words) for name in own)


def nearest_only(matches: list[dict]) -> list[dict]:
    """Matches without those that overlap one of another license with fewer edits, or with as many and more text.

    A pass in order of place: notices are short, so few are open at a time.
    """
    ordered = sorted(matches, key=lambda m: (m["start"], m["end"], m["notice"]))
    beaten, open_ones = set(), []
    for i, m in enumerate(ordered):
        open_ones = [j for j in open_ones if ordered[j]["end"] > m["start"]]
        for j in open_ones:
            o = ordered[j]
            if o["label"] != m["label"]:
                rank = [(x["edits"], x["start"] - x["end"]) for x in (m, o)]
                if rank[0] != rank[1]:
                    beaten.add(i if rank[0] > rank[1] else j)
        open_ones.append(i)
    return [m for i, m in enumerate(ordered) if i not in beaten]


def seeds_of(notice: str, edits: int) -> list[tuple[int, str]]:
    """(offset, piece): `edits` + 1 pieces, of which one at least stands unchanged in any match."""
    cuts = [round(k * len(notice) / (edits + 1)) for k in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def phrase_starts(words: Sequence[str], phrases: Sequence[str]) -> list[tuple[int, str]]:
    """(word position, phrase) of all places where a phrase's words stand consecutively."""
    by_last: dict[str, list[tuple[str, ...]]] = {}
    for phrase in phrases:
        by_last.setdefault(phrase.split()[-1], []).append(tuple(phrase.split()))
    found = []
    for at, word in enumerate(words):
        for phrase in by_last.get(word, ()):
            start = at + 1 - len(phrase)
            if start >= 0 and tuple(words[start : at + 1]) == phrase:
                found.append((start, " ".join(phrase)))
    return found


def seeker(notices: dict[str, str], settings: LicenseSettings):
    """Texts to base places and to windows of the word-joined text in which a notice may stand."""
    places = pa.list_(pa.struct([("at", pa.int64()), ("phrase", pa.string())]))
    windows = pa.list_(pa.struct([("notice", pa.string()), ("from_char", pa.int64()), ("window", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        pieces: dict[str, list[tuple[str, int, int]]] = {}
        for notice in notices:
            edits = edits_for(notice, settings)
            for offset, piece in seeds_of(notice, edits):
                pieces.setdefault(piece, []).append((notice, offset, edits))
        machine = ahocorasick.Automaton()
        for piece, uses in pieces.items():
            machine.add_word(piece, (len(piece), uses))
        machine.make_automaton()
        for batch in batches:
            bases, candidates, counts = [], [], []
            for text in batch.column("text").to_pylist():
                words = WORDS.findall(text.encode().lower().decode())
                counts.append(len(words))
                bases.append([{"at": at, "phrase": phrase} for at, phrase in phrase_starts(words, tuple(PHRASES))])
                joined = " ".join(words)
                spans: dict[str, list[list[int]]] = {}
                for end, (length, uses) in machine.iter(joined):
                    for notice, offset, edits in uses:
                        low = max(0, end + 1 - length - offset - edits)
                        high = min(len(joined), end + 1 - length - offset + len(notice) + edits)
                        own = spans.setdefault(notice, [])
                        if own and low <= own[-1][1]:
                            own[-1][0], own[-1][1] = min(own[-1][0], low), max(own[-1][1], high)
                        else:
                            own.append([low, high])
                candidates.append([{"notice": notice, "from_char": low, "window": joined[low:high]} for notice, own in spans.items() for low, high in own])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(bases, places), pa.array(candidates, windows)], ["doc_id", "n_words", "places", "windows"])

    return run


def verifier(settings: LicenseSettings):
    """Distinct (notice, window) to the spans of all matches within the allowed edits."""
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        patterns: dict[str, regex.Pattern] = {}
        for batch in batches:
            found = []
            for notice, window in zip(batch.column("notice").to_pylist(), batch.column("window").to_pylist(), strict=True):
                if notice not in patterns:
                    patterns[notice] = regex.compile(rf"(?b)(?<!\S)(?:{regex.escape(notice, special_only=True, literal_spaces=True)}){{e<={edits_for(notice, settings)}}}(?!\S)")
                found.append([{"start": m.start(), "end": m.end(), "edits": sum(m.fuzzy_counts)} for m in patterns[notice].finditer(window) if names_stand(notice, m.group())])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("notice", "window")), pa.array(found, spans)], ["notice", "window", "matches"])

    return run


def keep_nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = [nearest_only(matches) for matches in batch.column("matches").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(kept, batch.column("matches").type)], ["row", "matches"])


def find_licenses(docs: DataFrame, notices: dict[str, str] | None = None, settings: LicenseSettings | None = None) -> DataFrame:
    """One row for each document: n_words, base places (word, phrase) and matched notices.

    `matches` has notice, label, start, end (code points of the words joined by
    single spaces) and edits. The words that name a license must stand in a match
    (see NAMES), and of overlapping matches the nearer and longer notice counts. Candidate windows are verified once for each
    distinct pair of notice and window, so a notice that a third of the corpus
    carries costs one check, and long windows are spread over all tasks. Null
    texts are empty; equal rows give equal rows.
    """
    settings, notices = settings or LicenseSettings(), notices or NOTICES
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_words long, places array<struct<at: long, phrase: string>>, windows array<struct<notice: string, from_char: long, window: string>>"
    rows = docs.select("doc_id", text_of().alias("text")).mapInArrow(seeker(notices, settings), schema)
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "seeds", compression="zstd")
    windows = rows.select("row", F.inline("windows"))
    # The check costs far more than its rows weigh, so they are dealt to as many tasks as a shuffle has, whatever their size.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = windows.select("notice", "window").distinct().repartition(parts, "notice", "window")
    checked = distinct.mapInArrow(verifier(settings), "notice string, window string, matches array<struct<start: long, end: long, edits: long>>")
    checked = stage(checked.where(F.size("matches") > 0), "checked")
    label = F.element_at(F.create_map(*(F.lit(x) for pair in notices.items() for x in pair)), F.col("notice"))
    hits = windows.join(checked, ["notice", "window"]).select("row", "from_char", "notice", label.alias("label"), F.inline("matches"))
    hit = F.struct("notice", "label", (F.col("start") + F.col("from_char")).alias("start"), (F.col("end") + F.col("from_char")).alias("end"), "edits")
    by_row = hits.groupBy("row").agg(F.collect_set(hit).alias("matches"))
    by_row = by_row.mapInArrow(keep_nearest, by_row.schema)
    return rows.drop("windows").join(by_row, "row", "left").drop("row")


def license_digest(docs: DataFrame) -> DataFrame:
    """Counts, first and last base place, labels, and a score: 1 for a base phrase, else the best share of unedited characters."""
    found = find_licenses(docs)
    labels = F.create_map(*(F.lit(x) for pair in PHRASES.items() for x in pair))
    base = F.array_distinct(F.transform("places", lambda p: F.element_at(labels, p["phrase"])))
    own = F.coalesce(F.transform("matches", lambda m: m["label"]), F.array().cast("array<string>"))
    at = F.transform("places", lambda p: p["at"])
    best = F.array_max(F.transform("matches", lambda m: 1 - m["edits"] / F.length(m["notice"])))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(at).alias("first_word"),
        F.array_max(at).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, own))), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
        F.size(F.coalesce("matches", F.array().cast("array<struct<notice: string, label: string, start: bigint, end: bigint, edits: bigint>>"))).cast("long").alias("n_notices"),
    )
