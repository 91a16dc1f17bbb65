from __future__ import annotations

import html
import re
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from digestry.functions import identity, text, times, urls


def apply(spark, values, expression, kind="string"):
    """Expression over a column `v`, results in input order."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def test_titles(spark):
    values = ["  ＧＲＡＰＨ\n Ranking  ", "Straße", None, "a\xa0　b c", "x\x1cy", "Ａ　Ｂ"]
    want = ["graph ranking", "strasse", "", "a b c", "x y", "a b"]
    assert apply(spark, values, text.normalize_title) == want


def test_full_nfkc_uses_every_compatibility_form(spark):
    assert apply(spark, ["ﬁne ² ①"], lambda v: text.normalize_title(v, full_nfkc=True)) == ["fine 2 1"]


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab \t\n\r\x0b\x1f\x85\xa0 　é中", max_size=12), min_size=60, max_size=60))
def test_collapse_agrees_with_python(spark, values):
    assert apply(spark, values, text.collapse) == [" ".join(v.split()) for v in values]
    assert apply(spark, values, text.strip) == [v.strip() for v in values]


def test_unescape_is_single_pass(spark):
    values = ["a &amp;lt; b", "caf&eacute; &#8212; &#x4e2d; &bogus; &apos;", "&amp;&amp;", "none", "&copy;&middot;&quot;", "&amp;eacute;", "&lt &"]
    want = [html.unescape(v) for v in values[:-1]] + ["&lt &"]
    assert apply(spark, values, text.unescape) == want


def test_bounded_text_strips_before_it_cuts(spark):
    assert apply(spark, ["<p>one&nbsp;<b>two</b></p>\n three"], lambda v: text.bounded_text(v, 9)) == ["one two t"]


def test_repeated_halves(spark):
    paragraph = ("A sufficiently long sentence with technical details. " * 3).strip()
    values = [
        f"{paragraph} {paragraph}", paragraph + paragraph, "short short", f"{paragraph} Different ending.",
        r"Lift 9.76\%, A\&B, item\_id and \#1; keep \alpha", "x" * 79 + " " + "x" * 79, "x" * 80 + "\n" + "x" * 80,
    ]
    want = [
        paragraph, paragraph, "short short", f"{paragraph} Different ending.",
        r"Lift 9.76%, A&B, item_id and #1; keep \alpha", "x" * 79 + " " + "x" * 79, "x" * 80,
    ]
    assert apply(spark, values, text.display_text) == want


def test_scripts_and_tokens(spark):
    assert apply(spark, ["中", "plain", None, "㐀", "ü"], text.has_script) == [True, False, False, True, False]
    assert apply(spark, ["", "abcd", "abcde", None], text.token_estimate) == [1, 1, 2, 1]


@pytest.mark.parametrize(
    "url, want",
    [
        ("http://Example.com:80/a/b/?b=2&a&utm_source=x#f", "http://example.com/a/b?a=&b=2"),
        ("https://h.example.org./", "https://h.example.org/"),
        ("HTTPS://h.org:8443//", "https://h.org:8443"),
        ("https://user:pw@h.org/", None),
        ("ftp://h.org/", None),
        ("http://h.org:99999/", None),
        ("http://h.org:x/", None),
        ("https://[2001:4860::1]:443/x", "https://[2001:4860::1]/x"),
        ("http://h.org/?q=a+b%20c&z=%zz&~=*", "http://h.org/?q=a+b+c&z=%25zz&~=%2A"),
        ("http://h.org/?UTM_x=1&FBCLID=2&gclid=3", "http://h.org/"),
        ("not a url", None),
        (None, None),
    ],
)
def test_urls(spark, url, want):
    assert apply(spark, [url], urls.normalize_url) == [want]


def test_public_url_reasons(spark):
    cases = {
        "https://example.org/x": None, "http://8.8.8.8/": None, "http://[2606:4700::1]/": None,
        "http://127.0.0.1/": "non_public_address", "http://100.64.0.1/": "non_public_address",
        "http://172.31.0.1/": "non_public_address", "http://172.32.0.1/": None, "http://[::1]/": "non_public_address",
        "http://[fd00::1]/": "non_public_address", "ftp://example.org/": "scheme", "http://a:b@example.org/": "host_or_credentials",
        "http://example.org:70000/": "port", "http://example.org/" + "x" * 2048: "missing_or_too_long",
    }
    assert apply(spark, list(cases), urls.public_url_reason) == list(cases.values())


def test_identity_precedence(spark):
    columns = "title string, url string, arxiv_id string, doi string, entry string"
    rows = [
        ("T", "http://a.org/b", "arXiv:2401.01v2", "10.1/x", None),
        ("T", "http://a.org/b", None, " <https://doi.org/10.1/AbC.>", None),
        ("T", "http://a.org/b/?utm_source=x", None, "11.1/no", None),
        ("T", "http://a.org/b", None, None, None),
        ("  ｔ ", None, None, None, None),
        ("T", None, None, None, None),
        ("T", None, None, None, "http://arxiv.org/abs/cs/0101v3"),
        ("T", None, None, None, "https://arxiv.org/pdf/2401.02v1.pdf"),
    ]
    frame = spark.createDataFrame(rows, columns).coalesce(1)
    ids = [r[0] for r in frame.select(identity.stable_id(*[F.col(c) for c in ("title", "url", "arxiv_id", "doi", "entry")])).collect()]
    assert ids[0] == "arxiv-2401.01"
    assert ids[1] == "doi-10.1-abc"
    assert ids[2] == ids[3] and ids[2].startswith("url-") and len(ids[2]) == 28
    assert ids[4] == ids[5] and ids[4].startswith("title-")
    assert ids[6:] == ["arxiv-cs-0101", "arxiv-2401.02"]


def test_windows(spark):
    leap = "timestamp'2024-02-29 00:00:00'"
    row = spark.range(1).select(
        times.window_lower(F.lit("paper"), F.expr(leap), F.lit(None).cast("timestamp")).alias("paper"),
        times.window_lower(F.lit("blog"), F.expr(leap), F.lit(None).cast("timestamp")).alias("blog"),
        times.window_lower(F.lit("paper"), F.expr(leap), F.expr(leap)).alias("paper_next"),
        times.window_lower(F.lit("blog"), F.expr(leap), F.expr(leap)).alias("blog_next"),
    ).first()
    assert list(row) == [datetime(2019, 2, 28), datetime(2021, 2, 28), datetime(2024, 2, 27), datetime(2024, 2, 22)]


def test_ages_are_cumulative_and_inclusive(spark):
    now = F.expr("timestamp'2026-08-15 00:00:00'")
    stamps = ["2026-08-08 00:00:00", "2026-08-07 23:59:59", "2027-01-01 00:00:00", "2025-08-14 00:00:00"]
    got = apply(spark, stamps, lambda v: times.age_buckets(v.cast("timestamp"), now))
    assert got == [["7d", "30d", "365d"], ["30d", "365d"], ["7d", "30d", "365d"], []]


def test_business_date_turns_at_sixteen_utc(spark):
    got = apply(spark, ["2026-08-14 15:59:59", "2026-08-14 16:00:00"], lambda v: times.business_date(v.cast("timestamp")).cast("string"))
    assert got == ["2026-08-14", "2026-08-15"]




def test_normalising_equals_the_long_way_for_every_kind_of_rare_character(spark):
    codes = [0x0B, 0x0C, 0x1C, 0x1F, 0x85, 0xA0, 0xE9, 0xDF, 0x1680, 0x2000, 0x200B, 0x2028, 0x202F, 0x205F, 0x3000, 0x3001, 0xFF00, 0xFF01, 0xFF21, 0xFF5E, 0xFF5F, 0x1F600]
    odd = [*map(chr, codes), "\n\t", "  "]
    values = [f" A{one}{two}b " for one in odd for two in ["", *odd]]
    spaces = "[\t-\r\x1c-\x20\x85\xa0  -     　]+"
    wide = {c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F)}
    want = [re.sub(spaces, " ", v.translate(wide).lower().replace("\xdf", "ss")).strip(" ") for v in values]
    assert apply(spark, values, text.normalize_title) == want
