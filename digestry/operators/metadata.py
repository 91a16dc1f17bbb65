"""Labels, summaries and relevance: from model responses where a batch is sound, from rules otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from digestry.config import GROUPS, Taxonomy
from digestry.functions.text import CJK, blank_to_null, has_script, has_text, strip
from digestry.operators.scoring import clamp

RESPONSE_FIELDS = ("id", "summary", "label", "relevance")


def rule_summary(excerpt: Column, limit: int, script: str = CJK) -> Column:
    """The start of the excerpt when readers can read it, else nothing."""
    start = F.substring(strip(excerpt), 1, limit)
    return F.when(has_script(start, script), start)


def ground(proposed: Column, supported: Column) -> Column:
    """Proposed labels that the item's own text supports, in the proposed order."""
    return F.filter(proposed, lambda label: F.array_contains(supported, label))


def rejected(proposed: Column, supported: Column) -> Column:
    return F.size(proposed) - F.size(ground(proposed, supported))


def ground_rows(proposals: DataFrame, supported: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Long form of `ground`: (kept, rejected) proposal rows."""
    return proposals.join(supported, list(keys), "left_semi"), proposals.join(supported, list(keys), "left_anti")


def supported_labels() -> Column:
    return F.concat(*[F.col(group) for group in GROUPS])


def parse_responses(responses: DataFrame, schema: str, allowed: Sequence[str], key: str) -> DataFrame:
    """Strip a code fence, require a JSON object with known keys; the reason says why a row is unusable."""
    trimmed = strip(F.col("output_text"))
    fenced = F.regexp_extract(trimmed, r"(?s)^```[^\n]*\n(.*)\n[^\n]*$", 1)
    body = F.when(trimmed.startswith("```"), fenced).otherwise(trimmed)
    parsed = responses.select(key, body.alias("body")).withColumn("value", F.try_parse_json("body"))
    reason = (
        F.when(F.col("value").isNull(), F.lit("not_json"))
        .when(~F.schema_of_variant("value").startswith("OBJECT"), F.lit("not_object"))
        .when(
            F.size(F.array_except(F.json_object_keys("body"), F.array(*[F.lit(a) for a in allowed]))) > 0,
            F.lit("unknown_field"),
        )
    )
    return parsed.select(key, reason.alias("reason"), F.when(reason.isNull(), F.from_json("body", schema)).alias("r"))


def assign_batches(df: DataFrame, order: Sequence[Column], size: int, within: Sequence[str] = ()) -> DataFrame:
    """Consecutive batches of `size` rows in a total order.

    Without `within` the numbering is global, which suits frames bounded by a
    cap. Large frames pass bucket columns, and every bucket is numbered alone.
    """
    window = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    number = F.row_number().over(window.orderBy(*order))
    return df.withColumn("batch", F.floor((number - 1) / size).cast("bigint"))


def validate_batches(
    requested: DataFrame, returned: DataFrame, batch_keys: Sequence[str], known_labels: Sequence[str],
    script: str = CJK,
) -> DataFrame:
    """One row per batch: sound only if exactly the requested ids came back once, all labels are known,
    every summary is readable and every relevance lies between 0 and 1."""
    keys = [*batch_keys, "id"]
    counted = returned.groupBy(*keys).agg(
        F.count("*").alias("copies"),
        F.bool_and(has_script(F.col("summary"), script)).alias("readable"),
        F.bool_and(
            F.forall("proposed", lambda label: label.isin(*known_labels))
        ).alias("known"),
        F.bool_and(F.coalesce(F.col("relevance").between(0, 1), F.lit(False))).alias("in_range"),
    )
    asked = requested.select(*keys).withColumn("asked", F.lit(True))
    pairs = asked.join(counted, keys, "full_outer")
    sound = (
        F.coalesce("asked", F.lit(False))
        & (F.coalesce("copies", F.lit(0)) == 1)
        & F.coalesce("readable", F.lit(False))
        & F.coalesce("known", F.lit(False))
        & F.coalesce("in_range", F.lit(False))
    )
    return pairs.groupBy(*batch_keys).agg(
        F.count_if(F.col("asked")).alias("requested"),
        F.coalesce(F.sum("copies"), F.lit(0)).alias("returned"),
        F.bool_and(sound).alias("ok"),
    )


def resolve(
    requested: DataFrame, returned: DataFrame, batches: DataFrame, batch_keys: Sequence[str], summary_limit: int,
    script: str = CJK,
) -> DataFrame:
    """Grounded model metadata for sound batches, rule metadata for every row of the others.

    `requested` is capped per kind and carries the excerpt, the start of which is
    the summary of a row by rule. Only answers of sound batches take part in the join: there every id occurs once.
    """
    flags = batches.where("ok").select(*batch_keys, F.lit(True).alias("sound"))
    model = returned.join(flags, list(batch_keys), "left_semi").select(
        *batch_keys, "id", F.col("summary").alias("m_summary"), F.col("proposed"), F.col("relevance")
    )
    rows = requested.join(flags, list(batch_keys), "left").join(model, [*batch_keys, "id"], "left")
    sound = F.coalesce("sound", F.lit(False))
    labels = {g: F.when(sound, ground(F.col("proposed"), F.col(g))).otherwise(F.col(g)) for g in GROUPS}
    lost = F.when(sound, rejected(F.col("proposed"), supported_labels())).otherwise(F.lit(0))
    return rows.select(
        *[c for c in requested.columns if c not in GROUPS],
        *[column.alias(group) for group, column in labels.items()],
        lost.alias("label_rejections"),
        F.when(sound, F.col("m_summary")).otherwise(rule_summary(F.col("excerpt"), summary_limit, script)).alias("summary"),
        F.when(sound, F.col("relevance")).otherwise(clamp(F.col("metadata_score"))).alias("relevance_score"),
        (~sound).alias("degraded"),
    )


def publishable(script: str = CJK) -> Column:
    """Degraded rows need a readable summary and a label in every group."""
    full = F.lit(True)
    for group in GROUPS:
        full = full & (F.size(group) > 0)
    return ~F.coalesce("degraded", F.lit(False)) | (has_script(F.col("summary"), script) & full)


def metadata_violations(metadata: DataFrame, taxonomy: Taxonomy, key: str = "id", script: str = CJK) -> DataFrame:
    """One row per broken rule: missing field, unknown label, missing or unreadable summary."""
    fields = ("summary", "relevance_score", "degraded", *GROUPS)
    rules = [F.when(F.col(f).isNull() & F.lit(f != "summary"), F.lit(f"missing_{f}")) for f in fields]
    for group in GROUPS:
        known = [label.id for label in taxonomy.group(group)]
        stray = F.exists(group, lambda label: ~label.isin(*known))
        rules.append(F.when(F.coalesce(stray, F.lit(False)), F.lit(f"unknown_{group}")))
    rules.append(F.when(~has_text(F.col("summary")), F.lit("no_summary")))
    unreadable = blank_to_null(F.col("summary")).isNotNull() & ~has_script(F.col("summary"), script)
    rules.append(F.when(unreadable, F.lit("unreadable_summary")))
    return metadata.select(key, F.explode(F.array_compact(F.array(*rules))).alias("rule"))
