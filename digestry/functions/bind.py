"""Evaluate an expensive expression once and use it several times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row.

    Inlining a regular expression over a long text into every place that needs
    it would run it again each time, because conditional branches are outside
    the reach of common-subexpression elimination.
    """
    return F.transform(F.array(value), body)[0]


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns whose expressions later filters and projections must not repeat.

    Catalyst moves a filter below the projection that defines its column and
    then evaluates that definition twice. A one-row generator stays where it
    is, while filters on other columns still pass it on their way to the scan.
    """
    kept = [F.col(name) for name in df.columns if name not in columns]
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*kept, F.inline_outer(F.array(row)))
