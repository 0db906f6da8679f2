"""Helpers shared by the training-data operators.

Internal columns start with ``__pm_`` so that extra columns of a caller's
table cannot clash with them.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from penmark.session import cut_lineage, ship_package

#: Bytes of text that one vectorised step of a Python kernel takes at a time.
STEP_BYTES = 1 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def numbered(df: DataFrame, *cols: str, name: str = "rows") -> DataFrame:
    """The named columns with a unique long ``__pm_row``, written to the shared
    folder: the number is fixed by the write, so a lost executor cannot change
    it, and rows that are equal in every column stay apart."""
    return cut_lineage(df.select(*cols).withColumn("__pm_row", F.monotonically_increasing_id()), name)


def row_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """(id, text hash) as join keys ``__pm_id``, ``__pm_h`` that name a row
    without writing it anew; rows with equal id and text share the key."""
    return [F.coalesce(F.col(id_col).cast("string"), F.lit("\x00")).alias("__pm_id"),
            F.xxhash64(F.col(text_col), F.length(F.col(text_col))).alias("__pm_h")]


def crc32_of(col: str) -> Column:
    """crc32 of an id written as text."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


def held_out(col: str, mod: int, rest: int) -> Column:
    """crc32(id as text) mod ``mod`` = ``rest``; a null id is held out."""
    return F.coalesce(crc32_of(col) % mod == rest, F.lit(True))


def bounded_sample(df: DataFrame, text_col: str, n: int) -> DataFrame:
    """At most ``n`` rows of distinct texts, those with the smallest hash: the
    same texts however the input is partitioned and however often it repeats one.

    Hashes alone give the limit, so only texts up to it are compared."""
    h = F.xxhash64(F.lit(7), F.col(text_col))
    last = df.select(h.alias("h")).distinct().orderBy("h").limit(n).agg(F.max("h")).first()[0]
    return df.where(h <= F.lit(last)).dropDuplicates([text_col]).orderBy(h, text_col).limit(n)


#: Labels that a sample is drawn for at most: a rating scale, not a measurement.
MAX_LABELS = 64


def labelled_sample(docs: DataFrame, labels: DataFrame, share, id_col: str, text_col: str) -> list[tuple]:
    """(label, text) rows for the driver: for each label ``share(number of labels)``
    distinct texts, those with the smallest hash; labels in order.

    ``labels`` has one row (__pm_id, __pm_y) for each id.  Ids and hashes alone are
    joined and grouped; the texts chosen are then fetched by id, so no other text
    leaves the task that reads it."""
    h = F.xxhash64(F.lit(7), F.col(text_col))
    narrow = (docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("__pm_id"), h.alias("__pm_h"))
              .join(labels, "__pm_id").groupBy("__pm_y", "__pm_h").agg(F.min("__pm_id").alias("__pm_id")))
    narrow = cut_lineage(narrow, "labelled")
    found = sorted(r[0] for r in narrow.select("__pm_y").distinct().limit(MAX_LABELS + 1).collect())
    if len(found) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} different labels")
    chosen = []
    for y in found:
        chosen += narrow.where(F.col("__pm_y") == y).orderBy("__pm_h").limit(share(len(found))).collect()
    if not chosen:
        return []
    picked = docs.sparkSession.createDataFrame(chosen, narrow.schema).toDF("__pm_y", "__pm_h", "__pm_id")
    texts = (docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("__pm_id"), h.alias("__pm_h"), F.col(text_col).alias("__pm_text"))
             .join(F.broadcast(picked), ["__pm_id", "__pm_h"]).groupBy("__pm_y", "__pm_h").agg(F.min("__pm_text").alias("t")))
    return [(r["__pm_y"], r["t"]) for r in sorted(texts.collect(), key=lambda r: (r["__pm_y"], r["__pm_h"]))]


def added(df: DataFrame, name: str) -> str:
    """``name`` for a column to add, with ``_`` after it for as long as the caller
    has a column called so: theirs is kept."""
    while name in df.columns:
        name += "_"
    return name


def by_bytes(texts, limit: int = STEP_BYTES):
    """Index ranges (a, b) over ``texts`` (bytes, str or None) whose total
    length is about ``limit``; a longer text stands alone."""
    a = size = 0
    for i, t in enumerate(texts):
        size += len(t) if t is not None else 0
        if size >= limit:
            yield a, i + 1
            a, size = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection of uint64 with good avalanche."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
