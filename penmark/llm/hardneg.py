"""Hard negatives by exact integer scores, multiplied in a residue number system.

Every component becomes ``floor(scale * x)``.  Matrices of the residues modulo
several small primes are multiplied in float32: a residue is at most half its
prime, the primes are small enough that a product's sum stays below 2^24, so
each float32 product is exact.  The signed score is put together again by
Chinese remaindering with balanced mixed-radix digits; as many primes are taken
as the longest vector of the data asks for.

An anchor's positives are its best rows of the same label; its negatives for a
positive are the best rows of other labels whose score lies in a window set by
the positive's score.  Anchors and rows are dealt into strips by the hash of
their id; a task holds one strip of each, multiplies them block by block and
gives its best few per anchor, which a ranking over all strips then merges.
A strip's size is bounded, whatever a label's share of the rows.

Defined results: rows with a null id, label or vector, with a null or non-finite
component, or of another vector length than most (the smaller length of equally
frequent ones) take no part; neither does an empty vector.  Of rows that share
an id the one smallest in (label, integer vector) counts, so repeated rows count
once.  Ties of score go to the smaller id.  An anchor with no positive, or a
positive with no row in its window, has no rows.  An empty table gives none.
Very long vectors are multiplied in pieces of 4,096 components.  Extra columns,
whatever their names, are ignored.  A score that could reach 2^56 is refused with a
``ValueError``: it would not fit the arithmetic of the windows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from penmark.session import cut_lineage

#: Components multiplied at once, and bytes of vectors in a strip of rows or of anchors.
SLAB = 4096
ROW_BYTES, ANCHOR_BYTES = 32 << 20, 8 << 20
#: Rows a strip has at least before there are more strips than one; sizes of a block product.
LEAST_ROWS = 4096
BLOCK_ANCHORS, BLOCK_ROWS = 256, 4096
MAX_BOUND = 1 << 56
NONE = np.iinfo(np.int64).min
LAST = np.iinfo(np.int64).max


# ------------------------------------------------------------- residue numbers

def is_prime(n: int) -> bool:
    return n > 1 and all(n % i for i in range(2, math.isqrt(n) + 1))


def primes_for(dim: int, bound: int) -> list[int]:
    """Odd primes, largest first, whose centred residues multiply exactly in
    float32 and whose product exceeds ``2 * bound``."""
    half = math.isqrt(((1 << 24) - 1) // max(1, min(dim, SLAB)))
    out, product, p = [], 1, min(2 * half + 1, 4093)
    while product <= 2 * bound:
        if p < 3:
            raise ValueError("scores too large for the residue system")
        if is_prime(p):
            out.append(p)
            product *= p
        p -= 2
    return out


def centred(x: np.ndarray, p: int) -> np.ndarray:
    """The residue of smallest size; ``x`` holds whole float32 numbers below 2^24."""
    p = np.float32(p)
    x = x - p * np.rint(x / p)
    return x - p * np.rint(x / p)


def residues(m: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """One float32 matrix of centred residues for each prime."""
    return [centred((m % p).astype(np.float32), p) for p in primes]


def scores(a: list[np.ndarray], c: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact int64 products of every row behind ``a`` with every row behind ``c``."""
    digits: list[np.ndarray] = []
    for i, p in enumerate(primes):
        s = None
        for at in range(0, a[i].shape[1], SLAB):
            part = centred(a[i][:, at:at + SLAB] @ c[i][:, at:at + SLAB].T, p)
            s = part if s is None else centred(s + part, p)
        for q, digit in zip(primes, digits):
            s = centred(centred(s - digit, p) * np.float32(pow(q, -1, p)), p)
        digits.append(s)
    out = digits[-1].astype(np.int64)
    for p, digit in zip(primes[-2::-1], digits[-2::-1]):
        out *= p
        out += digit.astype(np.int64)
    return out


# ------------------------------------------------------------- best of a block

def best(s: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest of each row of ``s`` with their ids, which ascend, so the
    first of equal scores is the smaller id.  NONE marks what does not count;
    ``s`` is used up."""
    at = np.arange(len(s))
    got = np.full((len(s), k), NONE), np.full((len(s), k), LAST)
    for j in range(min(k, s.shape[1])):
        i = s.argmax(1)
        top = s[at, i]
        if (top == NONE).all():
            break
        got[0][:, j], got[1][:, j] = top, np.where(top == NONE, LAST, ids[i])
        s[at, i] = NONE
    return got


def merged(x, y, k: int):
    s, i = np.hstack([x[0], y[0]]), np.hstack([x[1], y[1]])
    order = np.lexsort((i, -np.maximum(s, NONE + 1)), axis=1)[:, :k]
    return np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)


def strip(t: pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, labels, matrix) of a strip, by ascending id."""
    ids = t["vec_id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    flat = t["c"].combine_chunks()
    flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
    m = flat.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dim)
    return ids[order], t["label"].to_numpy()[order], m[order]


def positives_of(a, c, primes: list[int], k: int):
    """Each anchor's k best rows of its own label."""
    (aid, alab, am), (cid, clab, cm) = a, c
    out = np.full((len(aid), k), NONE), np.full((len(aid), k), LAST)
    for label in np.unique(alab):
        mine, theirs = np.flatnonzero(alab == label), np.flatnonzero(clab == label)
        for x in range(0, len(theirs), BLOCK_ROWS):
            cols = theirs[x:x + BLOCK_ROWS]
            rc = residues(cm[cols], primes)
            for y in range(0, len(mine), BLOCK_ANCHORS):
                rows = mine[y:y + BLOCK_ANCHORS]
                s = scores(residues(am[rows], primes), rc, primes)
                s[aid[rows][:, None] == cid[cols][None, :]] = NONE
                out[0][rows], out[1][rows] = merged((out[0][rows], out[1][rows]), best(s, cid[cols], k), k)
    return out


def negatives_of(a, c, low: np.ndarray, high: np.ndarray, primes: list[int], k: int):
    """For each anchor and window (a column of ``low`` and ``high``) the k best
    rows of other labels inside; (anchors, windows, k)."""
    (aid, alab, am), (cid, clab, cm) = a, c
    n, w = low.shape
    out = np.full((n, w, k), NONE), np.full((n, w, k), LAST)
    for x in range(0, len(cid), BLOCK_ROWS):
        cols = slice(x, x + BLOCK_ROWS)
        rc = residues(cm[cols], primes)
        for y in range(0, n, BLOCK_ANCHORS):
            rows = slice(y, y + BLOCK_ANCHORS)
            s = scores(residues(am[rows], primes), rc, primes)
            s[alab[rows][:, None] == clab[cols][None, :]] = NONE
            for j in range(w):
                inside = np.where((s >= low[rows, j, None]) & (s <= high[rows, j, None]), s, NONE)
                got = best(inside, cid[cols], k)
                out[0][rows, j], out[1][rows, j] = merged((out[0][rows, j], out[1][rows, j]), got, k)
    return out


# ----------------------------------------------------------------------- Spark

def usable(rows: DataFrame, id_col: str, label_col: str, vec_col: str) -> DataFrame:
    """(vec_id, label, v array<double>) of the rows that take part."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & fine & (F.size("v") > 0)))


def strips_of(count: int, dim: int, limit: int, tasks: int) -> int:
    """Strips whose vectors fit ``limit`` bytes, and enough of them to use the
    cluster once there are rows for it."""
    return max(1, -(-count * dim * 8 // limit), min(tasks, -(-count // LEAST_ROWS)))


def mine(rows: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95,
         scale: float = 256.0, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on ``vec_id``.  A row of another label is a
    negative for a positive if ``low * positive_score <= 100 * negative_score <=
    high * positive_score``; both percentages lie between 0 and 127.
    """
    if not (0 <= low <= 127 and 0 <= high <= 127):
        raise ValueError("low and high are percentages between 0 and 127")
    spark = rows.sparkSession
    base = usable(rows, id_col, label_col, vec_col)
    norm = F.aggregate("v", F.lit(0.0), lambda t, x: t + F.pow(F.abs(x * scale) + 1, 2.0))
    size = (base.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows"), F.max(norm).alias("norm"))
            .orderBy(F.desc("rows"), "n").first())
    dim, bound = (size["n"], size["norm"]) if size else (1, 1.0)
    if not bound < MAX_BOUND:
        raise ValueError("components too large for exact scores")
    primes = primes_for(dim, int(bound) + 1)
    # of rows that share an id one counts; partial minima, so a hot id is one row per task
    one = (base.where(F.size("v") == dim)
           .select("vec_id", F.struct("label", F.transform("v", lambda x: F.floor(x * scale)).alias("c")).alias("r"))
           .groupBy("vec_id").agg(F.min("r").alias("r")).select("vec_id", "r.label", "r.c"))
    one = cut_lineage(one, "vectors")
    anchors = one.where(is_anchor)
    n, n_anchors = one.agg(F.count(F.lit(1)), F.count(F.when(is_anchor, 1))).first()
    tasks = spark.sparkContext.defaultParallelism
    across, down = strips_of(n, dim, ROW_BYTES, tasks), strips_of(n_anchors, dim, ANCHOR_BYTES, 1)
    key = F.xxhash64("vec_id")
    right = one.select(F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("down"),
                       F.pmod(key, F.lit(across)).cast("int").alias("across"), "*")

    def dealt(frame: DataFrame) -> DataFrame:
        return frame.select(F.pmod(key, F.lit(down)).cast("int").alias("down"),
                            F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("across"),
                            *[F.col(x).alias(x) for x in frame.columns])      # columns of their own: the other side is the same table

    def same(a: pa.Table, c: pa.Table) -> pa.Table:
        x = strip(a, dim)
        s, i = positives_of(x, strip(c, dim), primes, n_positives)
        found = s != NONE
        return pa.table({"anchor_id": np.repeat(x[0], found.sum(1)), "positive_id": i[found], "positive_score": s[found]})

    def other(a: pa.Table, c: pa.Table) -> pa.Table:
        a = a.sort_by("vec_id")
        x = strip(a, dim)
        pid, ps = np.zeros((len(a), n_positives), np.int64), np.zeros((len(a), n_positives), np.int64)
        there = np.zeros((len(a), n_positives), bool)
        for r, found in enumerate(a["found"].to_pylist()):
            for j, f in enumerate(found):
                pid[r, j], ps[r, j], there[r, j] = f["positive_id"], f["positive_score"], True
        lo, hi = np.where(there, -(-low * ps // 100), 1), np.where(there, high * ps // 100, 0)
        s, i = negatives_of(x, strip(c, dim), lo, hi, primes, n_negatives)
        r, j, k = np.nonzero(s != NONE)
        return pa.table({"anchor_id": x[0][r], "positive_id": pid[r, j], "positive_score": ps[r, j],
                         "negative_id": i[r, j, k], "negative_score": s[r, j, k]})

    pairs = dealt(anchors).groupBy("down", "across").cogroup(right.groupBy("down", "across"))
    near = pairs.applyInArrow(same, "anchor_id long, positive_id long, positive_score long")
    w = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    kept = near.withColumn("r", F.row_number().over(w)).where(F.col("r") <= n_positives)
    # at most n_positives entries an anchor
    found = kept.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("found"))
    found = cut_lineage(found, "positives")
    asked = anchors.join(found, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id")
    cells = dealt(asked).groupBy("down", "across").cogroup(right.groupBy("down", "across"))
    hard = cells.applyInArrow(other, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    w = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (hard.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n_negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
