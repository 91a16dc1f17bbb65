"""Running sums over a total order of rows, without a task that sees them all."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from digestry.session import stage

PART = "_range"


def running_sums(df: DataFrame, order: Sequence[Column], sums: Mapping[str, str], within: Sequence[str] = (), name: str = "ordered") -> DataFrame:
    """Add, for each `out: column` of `sums`, the sum of the column over all earlier rows.

    `order` must break ties between rows that differ. With `within`, whose
    columns must lead `order`, sums start anew for each of their values. Rows are
    range-partitioned, so a value that holds a third of all rows is spread over
    many ranges; each range sums its rows, and the ranges' totals (one row for
    each range and value that meet) are summed ahead of it. The partitioned
    table is written once, which fixes the ranges.
    """
    spread = stage(df.repartitionByRange(*order).withColumn(PART, F.spark_partition_id()), name)
    totals = spread.groupBy(PART, *within).agg(*(F.sum(c).alias(f"_ahead_{out}") for out, c in sums.items()))
    earlier = Window.partitionBy(*within).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    ahead = totals.select(
        F.col(PART).alias("_at"),
        *(F.col(c).alias(f"_of_{c}") for c in within),
        *(F.coalesce(F.sum(f"_ahead_{out}").over(earlier), F.lit(0)).alias(f"_ahead_{out}") for out in sums),
    )
    inside = Window.partitionBy(PART, *within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = spread.select("*", *(F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_in_{out}") for out, c in sums.items()))
    same = summed[PART] == ahead["_at"]
    for c in within:
        same = same & summed[c].eqNullSafe(ahead[f"_of_{c}"])
    return summed.join(ahead, same).select(*df.columns, *((F.col(f"_in_{out}") + F.col(f"_ahead_{out}")).alias(out) for out in sums))
