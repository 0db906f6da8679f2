"""Exact quantiles of many columns and groups by refining histograms.

One pass finds each group's and column's count and bounds.  Then every pass
counts the values that are still in question in equal bins between their bounds
(with each bin's own smallest and largest value), finds the bin of every wanted
rank by a running sum over the bins, and takes that bin as the new bounds.  A
rank is settled when its bin holds one value only; counts and lengths settle in
the first pass.  A pass's counts are combined in each task, so what is exchanged
is bins, not values, and a group's size is no task's size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from penmark.operators.joins import small_table
from penmark.session import cut_lineage

BINS = 4096


def exact_quantiles(rows: DataFrame, features: Sequence[str], by: Sequence[str], qs: Sequence[float]) -> DataFrame:
    """(by.., feature, q array): the quantiles ``qs`` of every feature (linear
    interpolation between neighbouring ranks, as ``percentile``), one row for
    each group and feature that has a value.

    ``rows`` is read once a pass: pass a narrow, materialised table.  NULL and NaN
    are left out; infinite values are kept as they sort."""
    group = [F.col(c).alias(f"g{i}") for i, c in enumerate(by)]
    g = [f"g{i}" for i in range(len(by))]
    each = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in features])
    values = rows.select(*group, F.explode(each).alias("e")).select(*g, "e.feature", "e.v").where(F.col("v").isNotNull() & ~F.isnan("v"))
    bounds = values.groupBy(*g, "feature").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    bounds = cut_lineage(bounds, "bounds")
    # the ranks on either side of each quantile's position
    at = [F.lit(float(q)) * (F.col("n") - 1) for q in qs]
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(a), F.ceil(a)) for a in at])))
    open_ = bounds.select(*g, "feature", F.explode(ranks).alias("rank"), F.lit(0).cast("bigint").alias("below"), "lo", "hi")
    done = open_.where("lo = hi").select(*g, "feature", "rank", F.col("lo").alias("v"))
    open_ = open_.where("lo < hi")
    keys = [*g, "feature"]

    while True:
        open_, n = small_table(open_)
        if n == 0:
            break
        # ranks with the same bounds share one histogram
        spans = open_.select(*keys, "lo", "hi").distinct()
        if n * 64 <= 1 << 20:
            spans = F.broadcast(spans)
        s = spans.select(*[F.col(c).alias(f"s_{c}") for c in keys], "lo", "hi")
        cond = (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi"))
        for c in keys:
            cond = cond & F.col(c).eqNullSafe(F.col(f"s_{c}"))
        # halves first: the difference of two finite bounds may exceed a double
        width = F.col("hi") / 2 - F.col("lo") / 2
        part = (F.col("v") / 2 - F.col("lo") / 2) / width
        finite = (F.abs("lo") < math.inf) & (F.abs("hi") < math.inf) & (width > 0)
        place = F.when(finite, F.least(F.floor(part * BINS), F.lit(BINS - 1)))
        place = place.otherwise(F.when(F.col("v") == F.col("lo"), -2).when(F.col("v") == F.col("hi"), BINS + 1).otherwise(0))
        hist = (values.join(s, cond).groupBy(*keys, "lo", "hi", place.cast("int").alias("bin"))
                .agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("least"), F.max("v").alias("most")))
        before = Window.partitionBy(*keys, "lo", "hi").orderBy("bin")
        hist = hist.withColumn("upto", F.sum("c").over(before))
        h = hist.select(*[F.col(c).alias(f"h_{c}") for c in [*keys, "lo", "hi"]], "c", "least", "most", "upto")
        hit = (F.col("rank") - F.col("below") >= F.col("upto") - F.col("c")) & (F.col("rank") - F.col("below") < F.col("upto"))
        for c in [*keys, "lo", "hi"]:
            hit = hit & F.col(c).eqNullSafe(F.col(f"h_{c}"))
        found = open_.join(h, hit).select(*keys, "rank", (F.col("below") + F.col("upto") - F.col("c")).alias("below"),
                                          F.col("least").alias("lo"), F.col("most").alias("hi"))
        found = cut_lineage(found, "refined")
        done = done.unionByName(found.where("lo = hi").select(*keys, "rank", F.col("lo").alias("v")))
        open_ = found.where("lo < hi")
    at_rank = done.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at"))
    b = bounds.select(*[F.col(c).alias(f"b_{c}") for c in keys], "n")
    cond = F.lit(True)
    for c in keys:
        cond = cond & F.col(c).eqNullSafe(F.col(f"b_{c}"))
    out = at_rank.join(b, cond)

    def value(a):
        low, high = F.element_at("at", F.floor(a)), F.element_at("at", F.ceil(a))
        return F.when(low == high, low).otherwise((F.ceil(a) - a) * low + (a - F.floor(a)) * high)
    return out.select(*[F.col(c).alias(name) for c, name in zip(g, by)], "feature", F.array(*[value(a) for a in at]).alias("q"))
