"""Registered queries: one per operator of the inventory.

Each entry is a Spark callable ``(spark, sf_dir) -> DataFrame`` over the full
test tables, and, where the operator is expressible in SQL, the DuckDB text
that computes the same rows.  Doubles are rounded to 6 decimals and integer
widths cast explicitly on both sides so the two engines hash alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c: str | Column) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def load_all() -> None:
    """Import the modules whose decorators fill the registry."""
    from penmark.plans import (  # noqa: F401
        q_profile, q_features, q_dataset, q_metrics, q_neighbours, q_ingest, q_models)
