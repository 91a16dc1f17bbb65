"""Stable identity of a candidate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from digestry.functions.bind import let
from digestry.functions.text import fold, normalize_title, strip, unescape
from digestry.functions.urls import normalize_url


def _present(text: Column) -> Column:
    return F.when(text != "", text)


# How DOIs and arXiv identifiers are written in public, and the characters that ids may have.
DOI = r"(?s)^[<>]*(?:https?://(?:dx\.)?doi\.org/|doi:\s*)?(10\..*?)[.,;)<>]*$"
ARXIV = r"(?is)^(?:arxiv:\s*)?(.*?)(?:v[0-9]+)?(?:\.(?:pdf|html))?$"
ARXIV_ADDRESS = r"(?i)arxiv\.org/(?:abs|pdf)/([^?#]+)"
ID_BREAKS = r"[^a-z0-9._]+"


def normalize_doi(doi: Column) -> Column:
    """The DOI in lower case without resolver address, brackets or closing punctuation, null if it is none."""
    written = F.lower(strip(unescape(F.coalesce(doi, F.lit("")))))
    return let(F.regexp_extract(written, DOI, 1), lambda d: F.when(F.contains(d, F.lit("/")), d))


def normalize_arxiv_id(arxiv_id: Column, entry_id: Column) -> Column:
    """Version-free identifier from the field, else from the entry address."""
    given = F.coalesce(_present(arxiv_id), F.regexp_extract(F.coalesce(entry_id, F.lit("")), ARXIV_ADDRESS, 1))
    return _present(F.translate(F.regexp_extract(strip(given), ARXIV, 1), "/", "-"))


def slug(text: Column) -> Column:
    return F.btrim(F.regexp_replace(fold(text), ID_BREAKS, "-"), F.lit("-"))


def _short_hash(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, 24)


def stable_id(
    title: Column, url: Column | None = None, arxiv_id: Column | None = None, doi: Column | None = None,
    entry_id: Column | None = None,
) -> Column:
    """arXiv identifier, else DOI, else address hash, else title hash."""
    choices = []
    if arxiv_id is not None or entry_id is not None:
        none = F.lit(None).cast("string")
        choices.append(
            F.concat(
                F.lit("arxiv-"),
                slug(normalize_arxiv_id(none if arxiv_id is None else arxiv_id, none if entry_id is None else entry_id)),
            )
        )
    if doi is not None:
        choices.append(F.concat(F.lit("doi-"), slug(normalize_doi(doi))))
    if url is not None:
        choices.append(F.concat(F.lit("url-"), _short_hash(normalize_url(url))))
    return F.coalesce(*choices, F.concat(F.lit("title-"), _short_hash(normalize_title(title))))
