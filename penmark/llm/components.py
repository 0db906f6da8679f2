"""Connected components of links as Spark joins (no graph on the driver)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penmark.session import cut_lineage


#: Links that one task goes through at the end (16 bytes each); more are solved in rounds.
ONE_TASK = 200_000


def forest(links: DataFrame) -> DataFrame:
    """Union-find inside each partition: its links (a, b) become links of every
    node to its smallest one, so fewer and shorter chains are shuffled."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        up: dict = {}

        def root(x):
            while up.get(x, x) != x:
                up[x] = up.get(up[x], up[x])
                x = up[x]
            return x

        for p in batches:
            for a, b in zip(p["a"].tolist(), p["b"].tolist()):
                ra, rb = root(a), root(b)
                if ra != rb:
                    up[max(ra, rb)] = min(ra, rb)
                if len(up) >= 500_000:      # bounded memory: pass on what is known and start anew
                    yield pd.DataFrame([(root(x), x) for x in list(up) if root(x) != x], columns=["a", "b"])
                    up.clear()
        yield pd.DataFrame([(root(x), x) for x in list(up) if root(x) != x], columns=["a", "b"])

    return links.select("a", "b").mapInPandas(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for each node of ``links``
    (a, b).

    Rounds of smallest neighbouring label, then the label's own label, until
    nothing changes.  Both steps are joins on keys with one row on one side, so
    a node with very many links is split by the planner, not one task's group.
    """
    edges = cut_lineage(forest(links).where("a <> b").distinct(), "edges")
    if edges.count() <= ONE_TASK:       # what partitions left over fits one task's union-find: one pass instead of rounds
        star = cut_lineage(forest(edges.coalesce(1)), "stars")
        return star.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
            star.select(F.col("a").alias("node"), F.col("a").alias("component"))).distinct()
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    label = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        near = (both.join(label.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near")))
        low = label.join(near, "node").select("node", F.col("component").alias("old"),
                                              F.least("component", "near").alias("low"))
        own = label.select(F.col("node").alias("low"), F.col("component").alias("next"))
        new = cut_lineage(low.join(own, "low").select("node", "old", F.least("low", "next").alias("component")), "labels")
        if new.where("component <> old").limit(1).count() == 0:
            return new.select("node", "component")
        label = new.select("node", "component")
