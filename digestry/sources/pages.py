"""Title and article text of stored web pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from digestry.functions.bind import let
from digestry.functions.text import bounded_text

# Parts of a page that never belong to the article.
_NOISE = "(?is)<(?:!--.*?-->|" + "|".join(
    rf"{tag}\b[^>]*>.*?</{tag}\s*>" for tag in ("script", "style", "noscript", "nav", "header", "footer", "aside")
) + ")"
_ARTICLE = r"(?is)<article\b[^>]*>(.*)</article\s*>"
_BODY = r"(?is)<body\b[^>]*>(.*)</body\s*>"


def page_title(html: Column) -> Column:
    return bounded_text(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title", 1), 1000)


def article_text(html: Column) -> Column:
    """Text of the article element, else of the body, else of the whole page, noise removed."""

    def choose(page: Column) -> Column:
        article, body = F.regexp_extract(page, _ARTICLE, 1), F.regexp_extract(page, _BODY, 1)
        return F.coalesce(F.when(page.rlike("(?i)<article"), F.nullif(article, F.lit(""))), F.nullif(body, F.lit("")), page)

    return bounded_text(let(F.regexp_replace(F.coalesce(html, F.lit("")), _NOISE, " "), choose))
