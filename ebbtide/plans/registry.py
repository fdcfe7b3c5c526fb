"""Registered queries: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a function under its own name."""
    QUERIES[function.__name__] = function
    return function


def load() -> dict[str, Query]:
    from ebbtide.plans import (  # noqa: F401
        queries_evaluation, queries_events, queries_features, queries_models, queries_monitoring, queries_scoring,
    )

    return dict(QUERIES)
