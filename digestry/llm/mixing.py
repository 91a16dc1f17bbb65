"""Mixing sources to target weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestry.llm.ordered import running_sums
from digestry.llm.texts import SPACED, text_of
from digestry.session import stage

SEED = 20_260_815


def random_key(seed: int = SEED) -> Column:
    """A number for each document that any rerun gives again."""
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))


def sizes(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, source, size (words) and the random key; texts stay behind."""
    return docs.select("doc_id", "source", F.regexp_count(text_of(), F.lit(SPACED)).cast("long").alias("size"), random_key(seed).alias("key"))


def source_targets(measured: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, epochs: int = 2) -> DataFrame:
    """source, source_size, weight and target, one row for each source.

    Weights go round in code point order of the sources, null last. The targets
    are min(epochs * size, level * weight); the level at which they add up to
    share * all words is the only one, and is what resharing the excess by weight
    ends at. It follows from running sums in order of epochs * size / weight:
    where all sources before one are full, the rest is left to the weights from it
    on, and the first source that is not full itself gives the level.
    """
    per_source = measured.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1))
    by_name = [F.col("source").asc_nulls_last()]
    turn = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("place") % len(weights) + 1).cast("int"))
    known = running_sums(per_source, by_name, {"place": "one"}, name="sources")
    known = known.select("source", "source_size", turn.alias("weight"), (F.lit(epochs) * F.col("source_size")).alias("full"))
    filled = running_sums(known.withColumn("level_full", F.col("full") / F.col("weight")), [F.col("level_full"), *by_name], {"full_before": "full", "weight_before": "weight"}, name="levels")
    whole = filled.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weights")).first()  # one row
    wanted = min(share, float(epochs)) * (whole["words"] or 0)
    level = (F.lit(wanted) - F.col("full_before")) / (F.lit(whole["weights"] or 1.0) - F.col("weight_before"))
    found = filled.where(level <= F.col("level_full") * (1 + 1e-12)).agg(F.min_by(level, "weight_before").alias("level")).first()["level"] or 0.0
    return filled.select("source", "source_size", "weight", F.least(F.col("full").cast("double"), F.lit(found) * F.col("weight")).alias("target"))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, epochs: int = 2, seed: int = SEED) -> DataFrame:
    """How many words of each document a mix takes; one row for each row of `docs`.

    Each source is sorted by the random key and read over and over until its
    target is reached: `copies` whole passes, then a last pass that ends at
    exactly the word where the budget does, so at most one document of a source
    is `cut`. Words of all passes are in `taken`. Null texts have size 0, null is
    a source of its own, and equal rows share a key and are taken one after the
    other. `key` and `ahead` (words before it in its source) are returned too.
    """
    measured = stage(sizes(docs, seed), "sizes")
    targets = stage(source_targets(measured, weights, share, epochs), "targets")
    order = [F.col("source").asc_nulls_last(), F.col("key"), F.col("doc_id"), F.col("size")]
    placed = running_sums(measured, order, {"ahead": "size"}, within=["source"], name="placed")
    of = targets.withColumnRenamed("source", "_source")
    budget = F.round("target").cast("long")
    copies = F.when(F.col("source_size") > 0, F.expr("_budget div source_size")).otherwise(F.lit(0))
    rest = F.col("_budget") - F.col("copies") * F.col("source_size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("ahead")))
    return (
        placed.join(of, placed["source"].eqNullSafe(of["_source"]))
        .withColumn("_budget", budget)
        .withColumn("copies", copies)
        .withColumn("last", last)
        .select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size") + F.col("last")).alias("taken"), "source", "weight", "copies", "last", (F.col("last").between(1, F.col("size") - 1)).alias("cut"), "key", "ahead")
    )


def write_mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, epochs: int = 2, seed: int = SEED) -> DataFrame:
    """The rows of `docs` as often as the mix takes them, with the columns of `docs`.

    Documents are not torn: the one that a source's budget cuts is whole in the
    last pass if at least half of it fits, and left out of that pass otherwise.
    Since a source is sorted by key, its last pass is all keys up to a limit, and
    texts meet only one small row for each source: they are never shuffled.
    """
    mixed = mix(docs, weights, share, epochs, seed)
    goes = F.col("last") * 2 >= F.col("size")
    limits = stage(
        mixed.groupBy("source").agg(F.max("copies").alias("_copies"), F.max(F.when(goes & ((F.col("last") > 0)), F.col("key"))).alias("_limit")).withColumnRenamed("source", "_source"), "limits"
    )
    keyed = docs.withColumn("_key", random_key(seed))
    times = F.col("_copies") + (F.col("_key") <= F.coalesce(F.col("_limit"), F.lit(-(2**63)))).cast("long")
    joined = keyed.join(limits, keyed["source"].eqNullSafe(limits["_source"])).withColumn("_times", times).where("_times > 0")
    return joined.select(*(joined[c] for c in docs.columns), F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_pass")).drop("_pass")
