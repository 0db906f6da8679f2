"""Joins the reference does implicitly (index alignment, dictionary lookups)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penmark.session import cut_lineage

# Largest lookup table broadcast without the optimizer's say.
MAX_BROADCAST_BYTES = 16 << 20


def small_table(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> tuple[DataFrame, int]:
    """Write a derived class-sized table once, and broadcast it if small.

    The table is cut off from its plan (so plans that use it stay short) and
    measured: rows and the length of their text form, the proof of size behind
    the broadcast hint.  A larger one is left to the planner and AQE's runtime
    statistics.  Returns the frame and its row count.
    """
    df = cut_lineage(df, "small")
    n, size = df.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()
    return (F.broadcast(df) if (size or 0) <= max_bytes else df), n


def hconcat_by_key(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Side-by-side columns of two frames of the same rows, aligned on a key.

    Both sides are keyed by the row id, so this is an inner equi-join; when
    both come from the same source, prefer adding the columns in one select.
    """
    keys = [key] if isinstance(key, str) else list(key)
    dup = [c for c in right.columns if c in left.columns and c not in keys]
    return left.join(right.drop(*dup), keys, "inner")


def map_lookup(df: DataFrame, mapping: DataFrame, key: str, value: str,
               out: str | None = None) -> DataFrame:
    """Dictionary lookup ``df[key] → mapping[value]`` (NULL when absent)."""
    m = mapping.select(F.col(key).alias("_k"), F.col(value).alias(out or value))
    m, _ = small_table(m)
    return df.join(m, F.col(key) == F.col("_k"), "left").drop("_k")
