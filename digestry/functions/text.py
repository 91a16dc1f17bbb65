"""Text normalisation and clean-up expressions."""

from __future__ import annotations

import html.entities
import json
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from digestry.functions.bind import let

# Whitespace as Unicode text processing understands it; Java's \s alone is ASCII.
WHITESPACE = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

# The same characters as a list, for trimming ends without a pattern.
SPACES = "".join(
    chr(code)
    for first, last in (
        (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
        (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
    )
    for code in range(first, last + 1)
)

# Whitespace beyond space, tab and line breaks, written as a complement that plain text leaves quickly.
_RARE_SPACE = (
    r"[^\t\n\r\x20-\x84\x86-\x9f\xa1-\x{167f}\x{1681}-\x{1fff}\x{200b}-\x{2027}"
    r"\x{202a}-\x{202e}\x{2030}-\x{205e}\x{2060}-\x{2fff}\x{3001}-\x{10ffff}]"
)

# Full-width ASCII block and the ideographic space: the part of NFKC that changes matching in practice.
_WIDE = "".join(chr(code) for code in range(0xFF01, 0xFF5F)) + chr(0x3000)
_NARROW = "".join(chr(code - 0xFEE0) for code in range(0xFF01, 0xFF5F)) + " "

_WIDE_ANY = r"[\x{ff01}-\x{ff5e}\x{3000}]"

# The same and full-width characters: what texts need the long way for.
_RARE_OR_WIDE = _RARE_SPACE.replace(r"\x{3001}-\x{10ffff}", r"\x{3001}-\x{ff00}\x{ff5f}-\x{10ffff}")
_RARE_ASCII = r"[\x0b\x0c\x1c\x1d\x1e\x1f]"

# The CJK ranges that mark a displayable Chinese summary.
CJK = r"[\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}]"

TAG = r"<[^>]*>"


@F.pandas_udf(T.StringType())
def _nfkc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: unicodedata.normalize("NFKC", v), na_action="ignore")


def _has(text: Column, pattern: str) -> Column:
    """Whether a pattern of rare characters occurs; texts of ASCII alone are asked for those of its characters that are ASCII."""
    return F.when(F.octet_length(text) == F.length(text), text.rlike(_RARE_ASCII)).otherwise(text.rlike(pattern))


def _collapse_plain(text: Column) -> Column:
    """`collapse` of a text whose only whitespace is spaces, tabs and line breaks."""

    def squeeze(spaced: Column) -> Column:
        return F.when(F.contains(spaced, F.lit("  ")), F.regexp_replace(spaced, " {2,}", " ")).otherwise(spaced)

    for char in "\n\t\r":
        text = F.replace(text, F.lit(char), F.lit(" "))
    return F.trim(let(text, squeeze))


def _collapse_any(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, WHITESPACE + "+", " "))


def collapse(text: Column) -> Column:
    """Runs of whitespace become one space, ends trimmed.

    Texts with nothing but spaces, tabs and line breaks, which is most of them,
    get by with byte replacements; the full pattern is several times slower.
    """
    return let(text, lambda t: F.when(_has(t, _RARE_SPACE), _collapse_any(t)).otherwise(_collapse_plain(t)))


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(SPACES))


def fold(text: Column) -> Column:
    """Case folding; lower-casing alone keeps the German sharp s."""
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


def normalize_title(text: Column, full_nfkc: bool = False) -> Column:
    """Compatibility form, single spaces, trimmed, case folded. Null counts as empty.

    `full_nfkc` sends the text through an Arrow UDF for the complete NFKC form;
    by default the full-width block is mapped on the JVM.
    """
    text = F.coalesce(text, F.lit(""))
    if full_nfkc:
        return collapse(fold(_nfkc(text)))

    def choose(t: Column) -> Column:  # one search for both kinds of rare characters; folding makes neither
        narrow = F.when(t.rlike(_WIDE_ANY), F.translate(t, _WIDE, _NARROW)).otherwise(t)
        return F.when(_has(t, _RARE_OR_WIDE), _collapse_any(fold(narrow))).otherwise(_collapse_plain(fold(t)))

    return let(text, choose)


# Single-pass entity decoding ---------------------------------------------------------------------
# The entities that make up nearly all markup in feeds and pages.
_COMMON = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&apos;": "'",
    "&nbsp;": "\xa0",
    "&copy;": "©",
    "&middot;": "·",
}
_OTHER = r"&(?!amp;)(?:[A-Za-z][A-Za-z0-9]*|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});"
_PIECE = r"^&([A-Za-z][A-Za-z0-9]*|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});"


def _code_point(number: Column) -> Column:
    valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    packed = F.unhex(F.lpad(F.hex(number), 8, "0"))
    return F.when(valid, F.decode(packed, "UTF-32")).otherwise(F.lit(chr(0xFFFD)))


def _decode_all(text: Column) -> Column:
    known = {name: chr(point) for name, point in html.entities.name2codepoint.items()} | {"apos": "'"}
    names = F.from_json(F.lit(json.dumps(known)), "map<string,string>")  # one literal after constant folding

    def decode(piece: Column) -> Column:
        name = F.regexp_extract(piece, _PIECE, 1)
        rest = F.regexp_replace(piece, _PIECE, "")
        decimal = F.regexp_extract(name, r"^#([0-9]+)$", 1)
        hexadecimal = F.regexp_extract(name, r"^#[xX]([0-9A-Fa-f]+)$", 1)
        char = (
            F.when(decimal != "", _code_point(decimal.cast("bigint")))
            .when(hexadecimal != "", _code_point(F.conv(hexadecimal, 16, 10).cast("bigint")))
            .otherwise(F.try_element_at(names, name))
        )
        return F.when((name == "") | char.isNull(), piece).otherwise(F.concat(char, rest))

    return F.array_join(F.transform(F.split(text, "(?=&)"), decode), "")


def unescape(text: Column) -> Column:
    """Decode character references once: `&amp;lt;` becomes `&lt;`, not `<`."""
    return F.when(~F.contains(text, F.lit("&")), text).otherwise(let(text, _decode_once))


def _decode_once(text: Column) -> Column:
    simple = text
    for entity, char in _COMMON.items():
        simple = F.replace(simple, F.lit(entity), F.lit(char))
    simple = F.replace(simple, F.lit("&amp;"), F.lit("&"))
    bare = F.regexp_replace(text, "&(?:amp|" + "|".join(e[1:-1] for e in _COMMON) + ");", "")
    return F.when(bare.rlike(_OTHER), _decode_all(text)).otherwise(simple)


def bounded_text(text: Column, limit: int | None = None) -> Column:
    """Markup removed, entities decoded, single spaces; cut only where a limit is asked for."""
    clean = let(F.regexp_replace(F.coalesce(text, F.lit("")), TAG, " "), lambda bare: collapse(unescape(bare)))
    return clean if limit is None else F.substring(clean, 1, limit)


def blank_to_null(text: Column) -> Column:
    return F.when(F.length(strip(text)) > 0, text)


def has_text(text: Column) -> Column:
    return F.coalesce(F.length(strip(text)) > 0, F.lit(False))


def any_text(values: Column) -> Column:
    return F.coalesce(F.exists(values, has_text), F.lit(False))


def has_script(text: Column, script: str = CJK) -> Column:
    return F.coalesce(text.rlike(script), F.lit(False))


def token_estimate(text: Column) -> Column:
    """One token per four characters, rounded up, at least one."""
    return F.greatest(F.lit(1), F.floor((F.length(F.coalesce(text, F.lit(""))) + 3) / 4)).cast("bigint")


def drop_repeated_half(text: Column, min_chars: int = 80) -> Column:
    """Keep one half of a text that is an exact repeat, with optional whitespace between the halves."""

    def halves(whole: Column) -> Column:
        middle = F.floor(F.length(whole) / 2).cast("int")
        return F.struct(
            whole.alias("whole"),
            F.substring(whole, F.lit(1), middle).alias("left"),
            F.substring(whole, middle + 1, F.length(whole)).alias("right"),
        )

    def bare(parts: Column) -> Column:
        return F.struct(
            parts["whole"].alias("whole"),
            parts["left"].alias("left"),
            parts["right"].alias("right"),
            F.rtrim(parts["left"], F.lit(SPACES)).alias("head"),
            F.ltrim(parts["right"], F.lit(SPACES)).alias("tail"),
        )

    def choose(parts: Column) -> Column:
        plain = (parts["left"] == parts["right"]) & (F.length(parts["left"]) >= min_chars)
        divided = (
            (parts["head"] == parts["tail"])
            & (F.length(parts["head"]) >= min_chars)
            & (2 * F.length(parts["head"]) < F.length(parts["whole"]))
        )
        return F.when(plain, parts["left"]).when(divided, parts["head"]).otherwise(parts["whole"])

    return let(let(let(strip(F.coalesce(text, F.lit(""))), halves), bare), choose)


def display_text(text: Column) -> Column:
    """Repeated half removed and escaped percent, ampersand, underscore and hash signs restored."""
    escaped = lambda t: F.when(F.contains(t, F.lit("\\")), F.regexp_replace(t, r"\\([%&_#])", "$1")).otherwise(t)
    return let(drop_repeated_half(text), escaped)


def words_regex(term: str) -> str:
    """Whole-term pattern: no word character may touch either end.

    The term comes first and the look-behind last, so the engine searches for a
    literal instead of testing a look-behind at every position.
    """
    literal = re.escape(term)
    return rf"(?U){literal}(?!\w)(?<!\w{literal})"
