"""Small document tables with the cases that every operator must take, and plain helpers."""

from __future__ import annotations

import re
import string

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
BASE = "the quick brown fox jumps over the lazy dog while seven grey geese fly south past the old stone bridge near our mill and nobody in the village looks up from the long table of bread and salt"

# doc_id, text, lang, source, n_chars and columns whose names the operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, n long, score double, words string, row long, kept boolean, size long, start long, parts string"


def documents(spark, rows):
    """rows: (doc_id, text[, source])."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or ""), 1, 2, 0.5, "w", 3, True, 4, 5, "p") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def edge_rows():
    changed = BASE.replace("village", "valley")
    long_text = " ".join(f"word{i % 977} and{i % 31}" for i in range(30_000))
    return [
        (1, BASE, "a"), (2, changed, "a"), (3, BASE.upper(), "b"), (4, None, None), (5, "", "b"), (6, " \t\n ", "b"), (7, "one two", "c"), (8, "ONE  two", "c"),
        (9, long_text, "a"), (10, "Ünïcode 日本語 \U0001f600 ÉTÉ été", "é"), (2, changed, "a"), (1, "another text under a repeated id", "a"), (None, "no id here at all", None), (None, None, None),
        (11, BASE + " " + BASE[:60], "b"), (12, "x" * 5000, "b"),
    ]


def lowered_words(text):
    return WORD.findall((text or "").translate(LOWER))


def spaced_words(text):
    return (text or "").encode().lower().split()


def tuples(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)
