"""Registered queries: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its function name."""
    QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    from digestry.plans import (  # noqa: F401  (imported for registration)
        q_collect,
        q_graph,
        q_metadata,
        q_quality,
        q_readings,
        q_run,
        q_serve,
        q_state,
        q_streams,
    )

    return dict(QUERIES)
