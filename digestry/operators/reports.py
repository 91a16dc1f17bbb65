"""Run counters, success rates and source status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestry.functions.times import age_buckets, business_date
from digestry.operators.items import label_count


def funnel(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows per stage and kind, one column per kind."""
    tagged = None
    for name, frame in stages.items():
        part = frame.select(F.lit(name).alias("stage"), "kind")
        tagged = part if tagged is None else tagged.union(part)
    return tagged.groupBy("stage").agg(
        F.count_if(F.col("kind") == "paper").alias("papers"), F.count_if(F.col("kind") == "blog").alias("blogs")
    )


def metadata_counters(resolved: DataFrame, batches: DataFrame, minimum_relevance: float) -> DataFrame:
    """One row: batches, batch success rate, degraded rows, rejected labels and rows below the bar."""
    rows = resolved.agg(
        F.count_if("degraded").alias("degraded"),
        F.coalesce(F.sum("label_rejections"), F.lit(0)).alias("label_rejections"),
        F.count_if((F.col("relevance_score") < minimum_relevance) | (label_count() == 0)).alias(
            "relevance_rejections"
        ),
    )
    rate = F.when(F.count("*") > 0, F.count_if("ok") / F.count("*")).otherwise(F.lit(1.0))
    calls = batches.agg(F.struct(F.count("*").alias("calls"), rate.alias("rate")).alias("c")).scalar()
    counted = rows.withColumn("c", calls)
    return counted.select(*rows.columns, "c.calls", F.col("c.rate").alias("call_success_rate"))


def success_gate(rates: DataFrame, minimum: float) -> DataFrame:
    """Rates (name, succeeded, attempted) with the verdict; nothing attempted counts as one, the bound is inclusive."""
    rate = F.when(F.col("attempted") > 0, F.col("succeeded") / F.col("attempted")).otherwise(F.lit(1.0))
    return rates.select("name", "succeeded", "attempted", rate.alias("rate"), (rate >= minimum).alias("passed"))


def run_rate(gated: DataFrame) -> DataFrame:
    """The rate of the whole run is the lowest of its parts."""
    return gated.agg(F.min("rate").alias("rate"), F.bool_and("passed").alias("passed"))


def source_status(sources: DataFrame, warnings: DataFrame) -> DataFrame:
    """Per enabled source the first warning that starts with its id; success when there is none."""
    tagged = warnings.select(F.split_part("warning", F.lit(":"), F.lit(1)).alias("source_id"), "warning", "pos")
    first = tagged.groupBy("source_id").agg(F.min_by("warning", "pos").alias("warning"))
    enabled = sources.where("enabled").select("source_id")
    return enabled.join(first, "source_id", "left").select(
        "source_id", F.col("warning").isNull().alias("success"), "warning"
    )


def business_days(items: DataFrame) -> DataFrame:
    return items.groupBy(business_date(F.col("published_at")).alias("business_date"), "kind").agg(
        F.count("*").alias("n")
    )


def age_counts(items: DataFrame, now) -> DataFrame:
    buckets = age_buckets(F.col("published_at"), F.lit(now).cast("timestamp"))
    return items.select("kind", F.explode(buckets).alias("age")).groupBy("kind", "age").agg(F.count("*").alias("n"))


def distinct_years(items: DataFrame) -> DataFrame:
    return items.select(F.date_format("published_at", "yyyy").alias("year")).distinct()


def size_budget(items: DataFrame, warn_bytes: int, fail_bytes: int) -> DataFrame:
    size = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in items.columns])))
    total = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"))
    verdict = (
        F.when(F.col("bytes") > fail_bytes, F.lit("fail"))
        .when(F.col("bytes") > warn_bytes, F.lit("warn"))
        .otherwise(F.lit("ok"))
    )
    return total.withColumn("verdict", verdict)
