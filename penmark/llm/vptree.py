"""Nearest neighbours with vantage-point trees, one per shard.

Rows are scaled to unit length, where Euclidean distance is a metric and
orders like the cosine.  A shard's tree splits at the median distance to a
vantage point; a search skips a side that the triangle inequality excludes,
``|d(q, vp) - median| > factor * radius`` with the radius of the k-th best so
far.  Factor 1 is exact; a smaller one skips more.  Scores are cosines of the
original vectors in double precision.

Defined results: vectors that are null, zero, of another length than most, or
hold null or non-finite components take no part; of equal vectors only the
``k + 1`` smallest ids are indexed, since no other can be among the k nearest
(ties go to the smaller id); repeated ids with equal vectors count once; fewer
candidates than k give all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from penmark.session import cut_lineage

SHARD_ROWS = 4096
LEAF = 64
#: Queries that go down a tree together; a shard is copied and its tree built once for each block.
QUERY_BLOCK = 4096
#: What a product of unit vectors may differ by from the score in double precision, generously.
ROUNDING = 1e-9
#: Pairs that are scored at once.
PAIRS = 1 << 15


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v array<double>) of the vectors that take part."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    ok = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return rows.select(F.col(id_col).alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ok)


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(v, ids): each vector once with its k + 1 smallest ids.

    The smallest ids are found in two steps, first within a salt of the id, so
    that a vector which a third of all rows share is no single task's group.
    """
    salted = rows.distinct().withColumn("__pm_h", F.xxhash64("v")).withColumn("__pm_s", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
    w = Window.partitionBy("__pm_h", "v", "__pm_s").orderBy("vec_id")
    few = salted.withColumn("__pm_r", F.row_number().over(w)).where(F.col("__pm_r") <= k + 1)
    return few.groupBy("__pm_h", "v").agg(
        F.slice(F.array_sort(F.collect_list("vec_id")), 1, k + 1).alias("ids"))


def scaled(v: np.ndarray) -> np.ndarray:
    """Rows times powers of two, so huge and tiny components neither overflow nor vanish."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(1, keepdims=True))[1])


def units(v: np.ndarray) -> np.ndarray:
    """Rows of unit length."""
    v = scaled(v)
    return v / np.sqrt((v * v).sum(1))[:, None]


def pair_cosines(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosine of each row with the same row of ``q`` in double precision, row by row the
    same whatever stands beside it."""
    v, q = scaled(v), scaled(q)
    return (v * q).sum(1) / (np.sqrt((v * v).sum(1)) * np.sqrt((q * q).sum(1)))


def cosines(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosine of each row with ``q``."""
    return pair_cosines(v, np.broadcast_to(q, v.shape))


class Tree:
    """Nodes are (vantage row, median, inside, outside); a leaf is an array of rows.

    Queries go down the tree together: a node measures all that are still with it at
    once.  They first read the leaf they fall into, which gives each a radius, and then
    every side that the radius does not exclude."""

    def __init__(self, v: np.ndarray, ids: list[np.ndarray], seed: int = 5):
        self.v = v
        self.n_ids = np.array([len(x) for x in ids], np.int64)
        self.first_id = np.cumsum(self.n_ids) - self.n_ids
        self.ids = np.concatenate([np.asarray(x, np.int64) for x in ids]) if len(ids) else np.zeros(0, np.int64)
        self.unit = units(v)
        self.rng = np.random.default_rng(seed)
        self.root = self.build(np.arange(len(v)))

    def build(self, rows: np.ndarray):
        if len(rows) <= LEAF:
            return rows
        at = rows[self.rng.integers(len(rows))]
        rest = rows[rows != at]
        d = np.sqrt(((self.unit[rest] - self.unit[at]) ** 2).sum(1))
        median = np.median(d)
        inside = d <= median
        if inside.all() or not inside.any():       # equal distances split nothing
            return rows
        return at, median, self.build(rest[inside]), self.build(rest[~inside])

    def search(self, q: np.ndarray, qid: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the query, id, score) of each query's k best, best first, ties to the smaller id."""
        unit = units(q)
        at, found, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        low = np.full(len(q), -np.inf)              # the k-th best score so far
        home = np.full(len(q), -1, np.int64)        # the leaf a query fell into, by its first row

        def offer(rows: np.ndarray, who: np.ndarray):
            """The rows' ids to the queries ``who``: products tell which can matter, those are scored exactly."""
            nonlocal at, found, score
            near = unit[who] @ self.unit[rows].T
            least = low[who]
            if len(rows) > k + 1:
                least = np.maximum(least, np.partition(near, -(k + 1), axis=1)[:, -(k + 1)])
            i, j = np.nonzero(near >= least[:, None] - ROUNDING)
            i, j = who[i], rows[j]
            s = np.concatenate([np.zeros(0), *(pair_cosines(self.v[j[a:a + PAIRS]], q[i[a:a + PAIRS]]) for a in range(0, len(i), PAIRS))])
            n = self.n_ids[j]
            ids = self.ids[np.repeat(self.first_id[j] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
            i, s = np.repeat(i, n), np.repeat(s, n)
            new = (ids != qid[i]) & (s >= low[i])
            if not new.any():
                return
            met = np.zeros(len(q), bool)
            met[i[new]] = True
            old = met[at]
            i, ids, s = np.concatenate([at[old], i[new]]), np.concatenate([found[old], ids[new]]), np.concatenate([score[old], s[new]])
            order = np.lexsort((ids, -s, i))
            i, ids, s = i[order], ids[order], s[order]
            rank = np.arange(len(i)) - np.searchsorted(i, i)
            low[i[rank == k - 1]] = s[rank == k - 1]
            top = rank < k
            at, found, score = np.concatenate([at[~old], i[top]]), np.concatenate([found[~old], ids[top]]), np.concatenate([score[~old], s[top]])

        def away(vantage: int, who: np.ndarray) -> np.ndarray:
            return np.sqrt(((unit[who] - self.unit[vantage]) ** 2).sum(1))

        def fall(node, who: np.ndarray):
            if not len(who):
                return
            if isinstance(node, np.ndarray):
                if len(node):
                    home[who] = node[0]
                    offer(node, who)
                return
            vantage, median, inside, outside = node
            near = away(vantage, who) <= median
            fall(inside, who[near])
            fall(outside, who[~near])

        def visit(node, who: np.ndarray):
            if isinstance(node, np.ndarray):
                if len(node):
                    who = who[home[who] != node[0]]
                if len(node) and len(who):
                    offer(node, who)
                return
            if not len(who):
                return
            vantage, median, inside, outside = node
            offer(np.array([vantage]), who)
            d = away(vantage, who)
            for side, past in ((inside, d - median), (outside, median - d)):
                radius = np.sqrt(np.maximum(0.0, 2 - 2 * low[who])) + 1e-6
                visit(side, who[past <= np.maximum(0.0, factor * radius)])

        everyone = np.arange(len(q))
        fall(self.root, everyone)
        visit(self.root, everyone)
        order = np.lexsort((found, -score, at))
        return at[order], found[order], score[order]


def search(rows: DataFrame, queries: DataFrame, k: int = 5, factor: float = 1.0, id_col: str = "vec_id",
           vec_col: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest of ``rows``, its
    own id left out.

    Every shard is met by every block of queries; a (shard, block) task holds
    one of each.  Its k best per query go on to be merged.
    """
    base = usable(rows, id_col, vec_col)
    size = base.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dim = size["n"] if size else 0
    base = base.where(F.size("v") == dim)
    found = cut_lineage(distinct_vectors(base, k), "vectors")
    shards = max(1, -(-found.count() // shard_rows))
    q = usable(queries, id_col, vec_col).where(F.size("v") == dim).distinct().withColumnRenamed("vec_id", "query_id")
    q = cut_lineage(q, "queries")
    blocks = max(1, -(-q.count() // QUERY_BLOCK))
    left = (found.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select("shard", "block", "v", "ids"))
    right = (q.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).select("shard", "block", "query_id", "v"))

    def pair(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if len(a) and len(b):
            tree = Tree(np.stack(a["v"].to_numpy()).astype(float), a["ids"].tolist())
            qid = b["query_id"].to_numpy()
            at, ids, score = tree.search(np.stack(b["v"].to_numpy()).astype(float), qid, k, factor)
            return pd.DataFrame({"query_id": qid[at], "vec_id": ids, "score": score})
        return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})

    near = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(
        pair, "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (near.distinct().withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def recall(found: DataFrame, truth: DataFrame, k: int = 5) -> float:
    """Share of the true k nearest among those found."""
    hit = found.join(truth, ["query_id", "vec_id"], "left_semi").count()
    return hit / max(1, truth.count())
