"""Feed payloads to candidate rows.

Every payload row is parsed on its own inside the scan stage, so the work
spreads with the number of payloads.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestry.functions.bind import compute_once, let
from digestry.functions.identity import normalize_arxiv_id, normalize_doi, stable_id
from digestry.functions.text import blank_to_null, bounded_text, has_text
from digestry.functions.urls import normalize_url

_ATOM_ENTRY = """
        title:string, id:string, published:string, updated:string, created:string, date:string, summary:string,
        author:array<struct<name:string>>, link:array<struct<_href:string,_rel:string>>, content:array<string>,
        dc_date:string, doi:string, arxiv_doi:string, prism_doi:string"""
ATOM = f"""
    entry array<struct<{_ATOM_ENTRY},
        category:array<struct<_term:string>>, arxiv_primary_category:struct<_term:string>>>,
    _corrupt_record string
"""
_ITEM = """array<struct<
        title:string, guid:string, link:string, pubDate:string, published:string, updated:string, date:string, dc_date:string,
        description:string, summary:string, author:array<string>, dc_creator:array<string>, doi:string, prism_doi:string,
        content:array<string>, content_encoded:array<string>, atom_link:array<struct<_href:string,_rel:string>>>>"""
# RSS 2.0 keeps its items in a channel, RSS 1.0 beside it, and Atom calls them entries.
BLOG = f"""
    channel struct<item:{_ITEM}>,
    item {_ITEM},
    entry array<struct<{_ATOM_ENTRY}>>,
    _corrupt_record string
"""

# The namespaces whose elements are read, with the name that their elements get here.
NAMESPACES = {
    "atom": "http://www.w3.org/2005/Atom",
    "dc": "http://purl.org/dc/elements/1.1/",
    "content": "http://purl.org/rss/1.0/modules/content/",
    "arxiv": "http://arxiv.org/schemas/atom",
    "prism": "http://prismstandard.org/namespaces/basic/2.0/",
}
# Hours from UTC of the zone names that mail dates use; any other name counts as UTC.
ZONES = {"EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7}
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_CLOCK = r"(?:[T\s]+(\d{1,2}):(\d{2})(?::(\d{2}(?:\.\d+)?))?)?\s*([A-Za-z]+|[+-]\d{2}:?\d{2})?\s*$"
ISO_DATE = r"^\s*(\d{4})-(\d{1,2})-(\d{1,2})" + _CLOCK
MAIL_DATE = r"^\s*(?:[A-Za-z]{2,9}\.?,?\s+)?(\d{1,2})[\s-]+([A-Za-z]{3})[a-z]*\.?[\s-]+(\d{4}|\d{2})" + _CLOCK


def _moment(text: Column) -> Column:
    """The time that an ISO or a mail date names, in UTC; null for anything else.

    Two-digit years from 90 on are of the last century. The date stands for its
    midnight where no clock is given, and times without a zone are UTC.
    """
    parts = F.when(text.rlike(ISO_DATE), F.regexp_replace(text, ISO_DATE, "$1|$2|$3|$4|$5|$6|$7")).when(
        text.rlike(MAIL_DATE), F.regexp_replace(text, MAIL_DATE, "$3|$2|$1|$4|$5|$6|$7")
    )
    return let(F.split(parts, r"\|"), _moment_of)


def _moment_of(parts: Column) -> Column:
    """Year, month, day, hour, minute, second and zone, as texts, to a time."""

    def number(index: int) -> Column:
        return F.get(parts, F.lit(index)).try_cast("int")

    year, zone = number(0), F.upper(F.get(parts, F.lit(6)))
    century = F.when(F.length(F.get(parts, F.lit(0))) > 2, 0).when(year < 90, 2000).otherwise(1900)
    month = F.coalesce(number(1), F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.get(parts, F.lit(1)))).cast("int"))
    seconds = F.coalesce(F.get(parts, F.lit(5)).try_cast("decimal(8,6)"), F.lit(0))
    local = F.try_make_timestamp(year + century, month, number(2), F.coalesce(number(3), F.lit(0)), F.coalesce(number(4), F.lit(0)), seconds, F.lit("UTC"))
    named = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in ZONES.items() for x in pair)), zone), F.lit(0)) * 60
    signed = F.replace(zone, F.lit(":"), F.lit("")).try_cast("int")  # +0130 is 130
    minutes = F.when(zone.rlike("^[+-]"), (signed / 100).cast("int") * 60 + signed % 100).otherwise(named)
    return local - F.make_interval(mins=minutes)


def _time(values: Column) -> Column:
    """First of the dates that can be read."""
    return F.get(F.filter(F.transform(values, _moment), lambda moment: moment.isNotNull()), F.lit(0))


def _excerpt(*values: Column, limit: int | None) -> Column:
    return bounded_text(F.concat_ws(" ", *[bounded_text(v, limit) for v in values]), limit)


def _names(values: Column) -> Column:
    """Trimmed, non-empty, first occurrence kept."""
    return F.array_distinct(F.filter(F.transform(F.coalesce(values, F.array()), lambda n: F.trim(n)), lambda n: n != ""))


def _under_name(name: str, both: Column) -> Column:
    """Elements of a prefix under another name; texts without such an element stay as they are."""
    opening = F.concat(F.lit("<"), both["prefix"], F.lit(":"))
    renamed = F.regexp_replace(both["text"], F.concat(F.lit("<(/?)"), both["prefix"], F.lit(":")), F.lit(f"<$1{name}_"))
    return F.when(F.contains(both["text"], opening), renamed).otherwise(both["text"])


def canonical_tags(payload: Column) -> Column:
    """Elements of the known namespaces under one name each, whatever prefix a feed declares for them.

    `<x:creator>` becomes `<dc_creator>` if x stands for Dublin Core; the usual
    prefix counts where none is declared. Elements of a feed whose root itself has
    a prefix lose that prefix. All others keep theirs, so that a foreign title or
    link never takes the place of the feed's own.
    """
    root = F.regexp_extract(payload, r"(?s)^\s*(?:<\?.*?\?>\s*|<!--.*?-->\s*|<!DOCTYPE[^>]*>\s*)*<([A-Za-z0-9._-]+):(?:feed|rss)\b", 1)
    tags = F.when(root != "", F.regexp_replace(payload, F.concat(F.lit("<(/?)"), root, F.lit(":")), F.lit("<$1"))).otherwise(payload)
    for name, uri in NAMESPACES.items():
        declared = F.regexp_extract(payload, r"xmlns:([A-Za-z0-9._-]+)\s*=\s*[\"']" + re.escape(uri) + r"[\"']", 1)
        prefix = F.when(F.contains(payload, F.lit(uri)), F.nullif(declared, F.lit("")))
        tags = let(F.struct(tags.alias("text"), F.coalesce(prefix, F.lit(name)).alias("prefix")), lambda both: _under_name(name, both))  # noqa: B023
    return tags


def _entries(feeds: DataFrame, entry: Column, schema: str) -> tuple[DataFrame, DataFrame]:
    parsed = compute_once(feeds, doc=F.from_xml(canonical_tags(F.col("payload")), schema, {"mode": "PERMISSIVE"}))
    listed = compute_once(parsed, entries=entry)
    empty = F.coalesce(F.size("entries"), F.lit(0)) <= 0
    malformed = F.col("doc._corrupt_record").isNotNull() | F.col("doc").isNull()
    errors = listed.where(empty & malformed).select("source_id", F.lit(None).cast("int").alias("entry_pos"), F.lit("malformed_feed").alias("code"))
    return listed.where(~empty).select(*feeds.drop("payload").columns, F.posexplode("entries").alias("entry_pos", "e")), errors


def scan_atom(feeds: DataFrame, excerpt_limit: int = 4000) -> tuple[DataFrame, DataFrame]:
    """Paper candidates and errors from Atom payloads (`source_id`, `payload`).

    Entries without title, date or address are dropped. Errors (source_id,
    entry_pos, code) tell malformed payloads without entries, and the entries that
    were dropped, with the first reason that holds.
    """
    rows, errors = _entries(feeds, F.col("doc.entry"), ATOM)
    url = normalize_url(_link(F.col("e.link")))
    terms = F.concat(
        F.coalesce(F.transform("e.category", lambda c: c["_term"]), F.array()),
        F.array_compact(F.array(F.col("e.arxiv_primary_category._term"))),
    )
    entry_id = blank_to_null(F.col("e.id"))
    doi = F.coalesce(normalize_doi(F.col("e.arxiv_doi")), normalize_doi(F.col("e.prism_doi")), normalize_doi(F.col("e.doi")))
    dates = F.array("e.published", "e.updated", "e.created", "e.date", "e.dc_date")
    out = rows.select(
        *[c for c in rows.columns if c != "e"],
        F.lit("paper").alias("kind"),
        bounded_text(F.col("e.title"), 1000).alias("title"),
        url.alias("url"),
        _time(dates).alias("published_at"),
        _stated(dates).alias("stated_date"),
        _names(F.transform("e.author", lambda a: a["name"])).alias("authors"),
        _excerpt(F.col("e.summary"), limit=excerpt_limit).alias("excerpt"),
        entry_id.alias("source_entry_id"),
        normalize_arxiv_id(F.lit(None).cast("string"), entry_id).alias("arxiv_id"),
        doi.alias("doi"),
        F.array_distinct(F.filter(terms, lambda t: t != "")).alias("categories"),
    )
    return _complete(out, errors)


def _stated(dates: Column) -> Column:
    """The first date that the entry states, readable or not."""
    return F.get(F.filter(dates, has_text), F.lit(0))


def _link(links: Column) -> Column:
    """The alternate or canonical link, else the first one."""
    links = F.filter(F.coalesce(links, F.array()), lambda l: F.coalesce(l["_href"], F.lit("")) != "")
    fitting = F.filter(links, lambda l: F.coalesce(l["_rel"], F.lit("alternate")).isin("alternate", "canonical"))
    return F.coalesce(F.get(fitting, F.lit(0))["_href"], F.get(links, F.lit(0))["_href"])


def _first_text(*lists: Column) -> Column:
    """First text of the lists, trimmed."""
    every = F.concat(*(F.coalesce(values, F.array().cast("array<string>")) for values in lists))
    return F.trim(F.get(F.filter(every, has_text), F.lit(0)))


def _common(guid, title, link, dates, texts, authors, content, doi) -> Column:
    return F.struct(
        guid.alias("guid"), title.alias("title"), link.alias("link"), F.array(*dates).alias("dates"),
        F.array(*texts).alias("texts"), authors.alias("authors"), content.alias("content"), doi.alias("doi"),
    )


def _from_item(e: Column) -> Column:
    authors = F.concat(F.coalesce(e["dc_creator"], F.array()), F.coalesce(e["author"], F.array()))
    dates = [e["pubDate"], e["published"], e["updated"], e["date"], e["dc_date"]]
    stated = F.filter(F.coalesce(e["atom_link"], F.array()), lambda l: l["_rel"].isin("alternate", "canonical"))
    link = F.coalesce(blank_to_null(F.get(stated, F.lit(0))["_href"]), blank_to_null(e["link"]), F.when(e["guid"].rlike("^https?://"), e["guid"]))
    doi = F.coalesce(e["doi"], e["prism_doi"])
    return _common(e["guid"], e["title"], link, dates, [e["summary"], e["description"]], authors, _first_text(e["content"], e["content_encoded"]), doi)


def _from_entry(e: Column) -> Column:
    names = F.transform(F.coalesce(e["author"], F.array()), lambda a: a["name"])
    dates = [e["published"], e["updated"], e["created"], e["date"], e["dc_date"]]
    none = F.lit(None).cast("string")
    doi = F.coalesce(e["doi"], e["prism_doi"])
    return _common(e["id"], e["title"], _link(e["link"]), dates, [e["summary"], none], names, _first_text(e["content"]), doi)


def scan_blog_feed(feeds: DataFrame, excerpt_limit: int = 4000) -> tuple[DataFrame, DataFrame]:
    """Blog candidates and source errors from RSS or Atom payloads, with full content where the feed carries it."""
    doc = F.col("doc")
    entries = F.concat(
        F.transform(F.coalesce(doc["channel"]["item"], F.array()), _from_item),
        F.transform(F.coalesce(doc["item"], F.array()), _from_item),
        F.transform(F.coalesce(doc["entry"], F.array()), _from_entry),
    )
    rows, errors = _entries(feeds, entries, BLOG)
    authors = F.array_distinct(
        F.transform(
            _names(F.col("e.authors")),
            lambda a: F.when(a.rlike(r"\([^()]+\)"), F.trim(F.regexp_extract(a, r"\(([^()]+)\)", 1))).otherwise(a),
        )
    )
    out = rows.select(
        *[c for c in rows.columns if c != "e"],
        F.lit("blog").alias("kind"),
        bounded_text(F.col("e.title"), 1000).alias("title"),
        normalize_url(F.col("e.link")).alias("url"),
        _time(F.col("e.dates")).alias("published_at"),
        _stated(F.col("e.dates")).alias("stated_date"),
        authors.alias("authors"),
        _excerpt(F.col("e.texts")[0], F.col("e.texts")[1], limit=excerpt_limit).alias("excerpt"),
        F.col("e.content").alias("feed_content"),
        blank_to_null(F.col("e.guid")).alias("source_entry_id"),
        F.lit(None).cast("string").alias("arxiv_id"),
        normalize_doi(F.col("e.doi")).alias("doi"),
        F.array().cast("array<string>").alias("categories"),
    )
    return _complete(out, errors)


def _complete(rows: DataFrame, errors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries with title, date and address under their stable id, and the others as errors."""
    known = compute_once(rows, title=F.col("title"), url=F.col("url"), published_at=F.col("published_at"))
    reason = (
        F.when(F.col("title") == "", F.lit("no_title"))
        .when(F.col("published_at").isNull(), F.when(F.col("stated_date").isNull(), F.lit("no_date")).otherwise(F.lit("unreadable_date")))
        .when(F.col("url").isNull(), F.lit("no_address"))
    )
    whole = known.where((F.col("title") != "") & F.col("published_at").isNotNull() & F.col("url").isNotNull()).drop("stated_date")
    dropped = known.where(reason.isNotNull()).select("source_id", "entry_pos", reason.alias("code"))
    return (
        whole.withColumn("id", stable_id(*[F.col(c) for c in ("title", "url", "arxiv_id", "doi", "source_entry_id")])),
        errors.unionByName(dropped),
    )


def source_errors(errors: DataFrame, feeds: DataFrame, sources: DataFrame) -> DataFrame:
    """(source_id, code, severity, n): what a collection run has to report for its enabled sources.

    A source without payload or with a malformed one is dead: an error if it is
    required, which stops the run, and a warning otherwise. Dropped entries are
    counted by reason as warnings.
    """
    enabled = sources.where("enabled").select("source_id", "required")
    missing = enabled.join(feeds.where(has_text(F.col("payload"))).select("source_id"), "source_id", "left_anti").select("source_id", F.lit("no_feed").alias("code"))
    dead = F.col("code").isin("no_feed", "malformed_feed")
    found = errors.select("source_id", "code").unionByName(missing).groupBy("source_id", "code").agg(F.count("*").alias("n"))
    return found.join(enabled, "source_id").select("source_id", "code", F.when(dead & F.col("required"), F.lit("error")).otherwise(F.lit("warning")).alias("severity"), "n")
