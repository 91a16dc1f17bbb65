"""Archive and facet search over published items."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestry.config import GROUPS, Taxonomy
from digestry.functions.text import normalize_title
from digestry.functions.times import age_buckets
from digestry.operators.items import label_map

# Words that find items by their kind.
KIND_WORDS = {"paper": "paper 论文 学术论文", "blog": "blog 博客 工程博客"}


def search_form(text: Column) -> Column:
    """Compatibility form, lower case, single spaces."""
    return normalize_title(text)


def query_terms(query: str) -> list[str]:
    return [term for term in query.split() if term]


def label_words(taxonomy: Taxonomy) -> Column:
    """Id and both names of every label of the row, in group order."""
    names = label_map(taxonomy)
    all_labels = F.concat(*[F.col(group) for group in GROUPS])
    words = F.transform(
        all_labels, lambda label: F.concat_ws(" ", label, F.element_at(names, label)["zh"], F.element_at(names, label)["en"])
    )
    return F.array_join(words, " ")


def archive_text(taxonomy: Taxonomy) -> Column:
    """Normalised search text of an archive row; a row-local expression, the taxonomy being a literal map."""
    kind = F.when(F.col("kind") == "paper", F.lit(KIND_WORDS["paper"])).otherwise(F.lit(KIND_WORDS["blog"]))
    return search_form(
        F.concat_ws(
            " ", "title", "summary", kind,
            F.date_format("digest_date", "yyyy-MM-dd"), F.date_format("published_at", "yyyy-MM-dd"),
            label_words(taxonomy),
        )
    )


def matches_query(text: Column, query: str) -> Column:
    """Every word of the query occurs somewhere; an empty query matches all."""
    condition = F.lit(True)
    for term in query_terms(query):
        condition = condition & F.contains(text, search_form(F.lit(term)))
    return condition


def matches_facets(selected: Mapping[str, Sequence[str]], now: datetime | None = None) -> Column:
    """Any value inside a facet, all facets together; facets without values do not restrict."""
    condition = F.lit(True)
    for facet, values in selected.items():
        if not values:
            continue
        if facet in GROUPS:
            condition = condition & F.arrays_overlap(F.col(facet), F.array(*[F.lit(v) for v in values]))
        elif facet == "year":
            condition = condition & F.date_format("published_at", "yyyy").isin(*values)
        elif facet == "age":
            buckets = age_buckets(F.col("published_at"), F.lit(now).cast("timestamp"))
            condition = condition & F.arrays_overlap(buckets, F.array(*[F.lit(v) for v in values]))
        else:
            condition = condition & F.col(facet).isin(*values)
    return condition


def archive_filter(rows: DataFrame, taxonomy: Taxonomy, query: str, selected: Mapping[str, Sequence[str]]) -> DataFrame:
    return rows.where(matches_facets(selected) & matches_query(archive_text(taxonomy), query))


def archive_counts(rows: DataFrame) -> DataFrame:
    """Section, day and grand totals in one pass."""
    return rows.rollup("digest_date", "kind").agg(F.count("*").alias("n"))


def facet_values(now: datetime) -> Column:
    """All (grp, value) facets of a row."""

    def tagged(name: str, values: Column) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(name).alias("grp"), v.alias("value")))

    return F.concat(
        tagged("kind", F.array("kind")),
        tagged("year", F.array(F.date_format("published_at", "yyyy"))),
        tagged("age", age_buckets(F.col("published_at"), F.lit(now).cast("timestamp"))),
        *[tagged(group, F.col(group)) for group in GROUPS],
    )


def facet_counts(matching: DataFrame, options: DataFrame, now: datetime) -> DataFrame:
    """Rows per facet value under the current filters; known values without rows keep a zero."""
    counted = (
        matching.select(F.explode(facet_values(now)).alias("f"))
        .groupBy(F.col("f.grp").alias("grp"), F.col("f.value").alias("value"))
        .agg(F.count("*").alias("n"))
    )
    return options.join(counted, ["grp", "value"], "left").select(
        "grp", "value", F.coalesce("n", F.lit(0)).alias("n")
    )


def page(results: DataFrame, order: Sequence[Column], number: int, size: int = 10) -> DataFrame:
    """One page of results, counted from one; a page needs a total order."""
    return results.orderBy(*order).offset((number - 1) * size).limit(size)


def label_chips(items: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """Card metadata: kind label, date and the labels with names as JSON, in group then item order."""
    names = label_map(taxonomy)

    def group_chips(group: str) -> Column:
        return F.transform(
            F.col(group),
            lambda label: F.struct(
                F.lit(group).alias("group"),
                F.element_at(names, label)["zh"].alias("name_zh"),
                F.element_at(names, label)["en"].alias("name_en"),
            ),
        )

    chips = F.concat(*[group_chips(group) for group in GROUPS])
    return items.select(
        "id", F.when(F.col("kind") == "paper", F.lit("论文")).otherwise(F.lit("博客")).alias("kind_label"),
        F.date_format("published_at", "yyyy-MM-dd").alias("published"), "summary", F.to_json(chips).alias("chips"),
    )
