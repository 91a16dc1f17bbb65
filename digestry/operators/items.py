"""Canonical items: readings joined with their metadata, relations pruned, provenance attached."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestry.config import GROUPS, Taxonomy

STAGE_ONLY = ("source_entry_id", "categories", "source_weight", "source_scenarios", "metadata_score", "degraded")


def assemble(readings: DataFrame, metadata: DataFrame, model: str, run_at: datetime) -> DataFrame:
    """Reading and metadata of the same id as one row of the item table.

    Papers keep their excerpt as the abstract; blogs keep neither excerpt nor
    paper identifiers. Provenance is filled in only where it is absent.
    """
    joined = metadata.join(readings.drop("kind"), "id")
    is_paper = F.col("kind") == "paper"
    provenance = F.struct(
        F.lit(model).alias("model"),
        F.lit(run_at).cast("timestamp").alias("generated_at"),
        F.coalesce("degraded", F.lit(False)).alias("degraded"),
    )
    existing = F.col("llm") if "llm" in joined.columns else F.lit(None).cast(
        "struct<model:string,generated_at:timestamp,degraded:boolean>"
    )
    return (
        joined.withColumn("llm", F.coalesce(existing, provenance))
        .withColumn("abstract", F.when(is_paper, F.coalesce("excerpt", F.lit(""))))
        .withColumn("arxiv_id", F.when(is_paper, F.col("arxiv_id")))
        .withColumn("doi", F.when(is_paper, F.col("doi")))
        .withColumnRenamed("source_id", "source")
        .drop("excerpt", *STAGE_ONLY)
    )


def orphan_readings(readings: DataFrame, metadata: DataFrame) -> DataFrame:
    """Readings nobody asked for; any row is an error."""
    return readings.join(metadata.select("id"), "id", "left_anti")


def allowed_targets(items: DataFrame, taxonomy_frame: DataFrame) -> DataFrame:
    """This run's items and the taxonomy labels. Items of earlier runs do not count."""
    return items.select("id").union(taxonomy_frame.select("id")).distinct().withColumnRenamed("id", "target_id")


def mark_relations(relations: DataFrame, targets: DataFrame) -> DataFrame:
    """Relations in long form with a `kept` flag.

    Relations stay one row each: an item with very many of them is never
    gathered into one array, and `pos` carries the source order.
    """
    known = targets.select("target_id", F.lit(True).alias("known"))
    joined = relations.join(known, "target_id", "left")
    return joined.withColumn("kept", F.coalesce("known", F.lit(False))).drop("known")


def pruning_warnings(marked: DataFrame, key: str = "id") -> DataFrame:
    """Per item the number of dropped relations and the first dropped target."""
    return (
        marked.where(~F.col("kept"))
        .groupBy(key)
        .agg(F.count("*").alias("pruned"), F.min_by("target_id", "pos").alias("first_target"))
    )


def json_bytes(columns: Sequence[str]) -> Column:
    """Bytes of a row's JSON form."""
    return F.octet_length(F.to_json(F.struct(*[F.col(c) for c in columns])))


def size_violations(items: DataFrame, limit: int, key: str = "id") -> DataFrame:
    """Items whose JSON form exceeds the limit in bytes."""
    return items.select(key, json_bytes(items.columns).alias("bytes")).where(F.col("bytes") > limit)


def upsert(history: DataFrame, current: DataFrame, key: str = "id") -> DataFrame:
    """Union in which the current run replaces earlier rows of the same id.

    Ids are unique on either side, so dropping the replaced rows is one
    anti-join instead of a sort over both tables.
    """
    return history.join(current.select(key), key, "left_anti").unionByName(current, allowMissingColumns=True)


def label_count() -> Column:
    return sum((F.size(group) for group in GROUPS), F.lit(0))


def explode_labels(items: DataFrame, *keep: str) -> DataFrame:
    """(keep..., grp, label, pos) rows; `pos` restores group order, then order inside the item."""

    def tagged(group: str, base: int) -> Column:
        return F.transform(
            F.col(group),
            lambda label, i: F.struct(
                F.lit(group).alias("grp"), label.alias("label"), (i + base).cast("int").alias("pos")
            ),
        )

    parts = F.concat(*[tagged(group, g * 10_000) for g, group in enumerate(GROUPS)])
    return items.select(*keep, F.inline(parts))


def label_map(taxonomy: Taxonomy) -> Column:
    """Label id to (zh, en) names as a literal map; the taxonomy is bounded by configuration."""
    pairs = [
        part
        for label in taxonomy.labels
        for part in (F.lit(label.id), F.struct(F.lit(label.name_zh).alias("zh"), F.lit(label.name_en).alias("en")))
    ]
    return F.create_map(*pairs)
