"""Related items by shared labels, exact and without pairing items with each other.

Items with the same label set are interchangeable as far as the number of
shared labels goes, so all pairing happens between distinct label sets:

1. Per label set keep the `limit + 1` best items (the extra one because an item
   is not related to itself).
2. An answer that shares exactly the labels U with the asking set must be among
   the `limit + 1` best items whose set contains U. So every answering set
   offers its best items under each of its subsets, and the asking set looks up
   each of its own subsets.
3. Sets with too many labels for their subsets to be listed are matched through
   an equi-join on labels between distinct sets instead. Both ways are exact.

The item table itself takes part in one pruned top-k and one join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestry.config import GROUPS
from digestry.operators.select_best import best_per_key
from digestry.session import stage


def _subsets(labels: Column) -> Column:
    """All non-empty subsets of a sorted label array."""
    empty = F.array(F.array().cast("array<string>"))
    grown = F.aggregate(
        labels,
        empty,
        lambda found, label: F.concat(found, F.transform(found, lambda s: F.array_append(s, label))),
    )
    return F.filter(grown, lambda s: F.size(s) > 0)


def _order() -> list[Column]:
    return [F.col("final_score").desc(), F.col("published_at").desc(), F.col("cand_id")]


def _set_matches(sets: DataFrame, best: DataFrame, keep: int, max_listed: int) -> DataFrame:
    """(asking set, shared, candidate) rows that contain every possible answer."""
    answers = best.select("labels", F.col("id").alias("cand_id"), "final_score", "published_at")
    small_answers = answers.where(F.size("labels") <= max_listed)
    offered = best_per_key(
        small_answers.withColumn("part", F.explode(_subsets(F.col("labels")))), ["part"], _order(), keep, "_r"
    ).select("part", F.col("labels").alias("cand_labels"), "cand_id", "final_score", "published_at")
    asking = sets.where(F.size("labels") <= max_listed).withColumn("part", F.explode(_subsets(F.col("labels"))))
    listed = asking.join(offered, "part").drop("part")

    asked = sets.withColumn("label", F.explode("labels"))
    answered = answers.withColumnRenamed("labels", "cand_labels").withColumn("label", F.explode("cand_labels"))
    big, small = F.size("labels") > max_listed, F.size("labels") <= max_listed
    wide = asked.where(big).join(answered, "label").unionByName(
        asked.where(small).join(answered.where(F.size("cand_labels") > max_listed), "label")
    )

    shared = F.size(F.array_intersect("labels", "cand_labels")).alias("shared")
    columns = ["labels", shared, "cand_id", "final_score", "published_at"]
    return listed.select(*columns).union(wide.select(*columns)).distinct()


def related_items(items: DataFrame, limit: int = 4, max_listed: int = 10) -> DataFrame:
    """(id, rank, related_id, shared) for items with at least one label in common.

    Order: shared labels, final score, date, id.
    """
    labels = F.array_sort(F.array_distinct(F.concat(*[F.col(group) for group in GROUPS])))
    labelled = items.select("id", "final_score", "published_at", labels.alias("labels")).where(F.size("labels") > 0)
    order: Sequence[Column] = [F.col("final_score").desc(), F.col("published_at").desc(), F.col("id")]
    # A few rows per label set, read several times below.
    best = stage(best_per_key(labelled, ["labels"], order, limit + 1, "_r").drop("_r"), "best-per-set")
    matches = _set_matches(best.select("labels").distinct(), best, limit + 1, max_listed)
    ranked = best_per_key(matches, ["labels"], [F.col("shared").desc(), *_order()], limit + 1, "pos")
    answers = ranked.groupBy("labels").agg(
        F.array_sort(F.collect_list(F.struct("pos", "cand_id", "shared"))).alias("answers")
    )
    others = F.filter("answers", lambda a: a["cand_id"] != F.col("id"))
    return (
        labelled.select("id", "labels")
        .join(answers, "labels")
        .select("id", F.posexplode(F.slice(others, 1, limit)).alias("i", "a"))
        .select("id", (F.col("i") + 1).alias("rank"), F.col("a.cand_id").alias("related_id"), F.col("a.shared").alias("shared"))
    )
