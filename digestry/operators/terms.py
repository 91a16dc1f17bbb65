"""Whole-term matching of a vocabulary against normalised text."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestry.config import GROUPS, Taxonomy
from digestry.functions.bind import compute_once
from digestry.functions.text import normalize_title, words_regex
from digestry.session import stage


def candidate_text(title: Column, excerpt: Column, categories: Column) -> Column:
    """The text that counts as evidence: title, excerpt and categories, never the source's own scenarios."""
    return normalize_title(F.concat_ws(" ", title, excerpt, categories))


def clean_terms(terms: Sequence[str]) -> tuple[str, ...]:
    return tuple(term.casefold().strip() for term in terms if term and term.strip())


def term_hits(text: Column, terms: Sequence[str]) -> Column:
    """Distinct terms that occur in the text, as a row-local expression.

    Every term is a literal: a byte search rules most of them out and the
    pattern, compiled once, decides the rest. Nothing is shuffled or exploded.
    """
    distinct = list(dict.fromkeys(clean_terms(terms)))
    found = [
        F.when(F.contains(text, F.lit(term)) & text.rlike(words_regex(term)), F.lit(term)) for term in distinct
    ]
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def term_coverage(hits: Column, terms: Sequence[str]) -> Column:
    """Share of the configured terms that matched; repeated terms count on both sides, no terms give zero."""
    wanted = clean_terms(terms)
    if not wanted:
        return F.lit(0.0)
    matched = F.size(F.array_intersect(F.array(*[F.lit(term) for term in dict.fromkeys(wanted)]), hits))
    for term, times in Counter(wanted).items():
        if times > 1:
            matched = matched + F.when(F.array_contains(hits, term), times - 1).otherwise(0)
    return F.least(F.lit(1.0), matched / F.lit(float(len(wanted))))


def label_hits(hits: Column, taxonomy: Taxonomy, group: str) -> Column:
    """Labels of a group with at least one matching term, in taxonomy order."""
    chosen = [
        F.when(F.arrays_overlap(hits, F.array(*[F.lit(t) for t in clean_terms(label.terms)])), F.lit(label.id))
        for label in taxonomy.group(group)
        if clean_terms(label.terms)
    ]
    return F.array_compact(F.array(*chosen)) if chosen else F.array().cast("array<string>")


def with_labels(df: DataFrame, taxonomy: Taxonomy, hits: str = "hits") -> DataFrame:
    return df.withColumns({group: label_hits(F.col(hits), taxonomy, group) for group in GROUPS})


def collection_gate(hits: Column, taxonomy: Taxonomy) -> Column:
    """Rows without any evidence term are not candidates."""
    return term_coverage(hits, taxonomy.evidence_terms()) > 0


# Runs of word characters, and every other character by itself: no term begins or ends inside such a token.
# The space and the plain letters in front decide most tokens; without them the pattern, \w+|\W, is the same but slower.
TOKEN = r"(?U) |[a-z]++\w*+|\w++|\W"
OTHER = r"(?Us)^\W$"


@dataclass(frozen=True)
class Form:
    """Terms of one length in tokens: whether any of them begins, or ends, with a character that is no word character."""

    length: int
    begins_other: bool = False
    ends_other: bool = False


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def is_other(token: Column) -> Column:
    return F.when(F.length(token) > 1, F.lit(False)).otherwise((token == " ") | token.rlike(OTHER))


def token_runs(texts: DataFrame, keys: Sequence[str], text: Column, forms: Sequence[Form]) -> DataFrame:
    """(keys, term): at every token of the text the runs of tokens that a term of these forms could equal, repeats included.

    Where a run begins or ends with another character than a word character,
    a word right beside it rules the run out. One row for each token comes
    first and takes its neighbours from the array, so that all of it is compiled.
    """
    cut = compute_once(texts.select(*keys, text.alias("_text")), _tokens=tokens(F.col("_text")))
    at = cut.select(*keys, "_tokens", F.posexplode("_tokens").alias("_at", "_token"))
    if not any(form.begins_other for form in forms):
        at = at.where(~is_other(F.col("_token")))

    def token(shift: int) -> Column:
        return F.get("_tokens", F.col("_at") + shift) if shift else F.col("_token")

    def run(form: Form) -> Column:
        whole = F.concat(*(token(i) for i in range(form.length)))  # null past the end
        stands = F.lit(True)
        if form.begins_other:
            stands = stands & ~(is_other(token(0)) & F.coalesce(~is_other(token(-1)), F.lit(False)))
        if form.ends_other:
            stands = stands & ~(is_other(token(form.length - 1)) & F.coalesce(~is_other(token(form.length)), F.lit(False)))
        return F.when(stands, whole)

    return at.select(*keys, F.explode(F.array(*map(run, forms))).alias("term")).where(F.col("term").isNotNull())


def vocabulary(terms: DataFrame) -> DataFrame:
    """Distinct folded terms (column term) with their number of tokens and how they begin and end."""
    folded = terms.select(normalize_title(F.col("term")).alias("term")).where(F.col("term") != "").distinct()
    return folded.select(
        "term", F.size(tokens(F.col("term"))).alias("length"),
        F.col("term").rlike(r"(?U)^\W").alias("begins_other"), F.col("term").rlike(r"(?U)\W$").alias("ends_other"),
    )


def _hits(texts: DataFrame, terms: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """(keys, term) of every match, repeats included."""
    words = stage(vocabulary(terms), "vocabulary")
    found = words.groupBy("length").agg(F.bool_or("begins_other").alias("b"), F.bool_or("ends_other").alias("e")).collect()  # one row for each length
    if not found:
        return texts.select(*keys, F.lit("").alias("term")).where(F.lit(False))
    runs = token_runs(texts, keys, F.col(text), [Form(r["length"], r["b"], r["e"]) for r in found])
    return runs.join(words.select("term"), "term").select(*keys, "term")


def match_terms(texts: DataFrame, terms: DataFrame, keys: Sequence[str] = ("id",), text: str = "text_norm") -> DataFrame:
    """(keys, term): the distinct terms of a table that occur in each text, for vocabularies of any size.

    The text is cut once into words and single other characters. Its runs of as
    many tokens as terms have are looked up as whole texts: the work depends on
    the text and on the number of different lengths, not on the number of terms,
    and equality is exact. Only keys and runs of a few words take part in the
    join, never the text; the staged vocabulary has a known size, so the planner
    broadcasts a small one and filters the runs ahead of the shuffle by a large
    one. A word of most texts meets a single term, which skew handling splits.
    """
    return _hits(texts, terms, keys, text).distinct()


def matched_terms(texts: DataFrame, terms: DataFrame, keys: Sequence[str] = ("id",), text: str = "text_norm") -> DataFrame:
    """(keys, terms): the terms of `match_terms` as one sorted array for each text that has any.

    Repeats meet in the set of their text ahead of the only shuffle, which moves
    one row for each text and input partition instead of one for each match. The
    first key should tell the most texts apart, as sets are gathered in key order.
    """
    return _hits(texts, terms, keys, text).groupBy(*keys).agg(F.sort_array(F.collect_set("term")).alias("terms"))
