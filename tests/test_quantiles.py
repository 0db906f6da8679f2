"""Refined histograms against the built-in percentile."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from penmark.operators import quantiles as Q

QS = [0.0, 0.25, 0.5, 0.777, 0.95, 1.0]


def both(spark, df, features, by):
    got = {tuple(r[c] for c in [*by, "feature"]): r["q"] for r in Q.exact_quantiles(df, features, by, QS).collect()}
    want = {}
    for f in features:
        rows = df.where(F.col(f).isNotNull() & ~F.isnan(f))
        for r in rows.groupBy(*by).agg(F.percentile(f, QS).alias("q"), F.count(F.lit(1)).alias("n")).collect():
            if r["n"]:
                want[tuple(r[c] for c in by) + (f,)] = r["q"]
    return got, want


def test_continuous_and_skewed_values(spark, monkeypatch):
    monkeypatch.setattr(Q, "BINS", 16)
    rng = np.random.default_rng(0)
    rows = []
    for i in range(1500):
        c = "hot" if i % 3 else ["a", "b", None][i % 9 // 3]
        rows.append((c, float(rng.normal()), float(np.exp(rng.normal() * 9)), float(i % 4), None if i % 5 else float("nan"), float(rng.choice([1e300, -1e300, 0.0, 5e-324]))))
    df = spark.createDataFrame(rows, "c string, x double, y double, z double, w double, e double")
    got, want = both(spark, df, ["x", "y", "z", "w", "e"], ["c"])
    assert got.keys() == want.keys() and len(got) == 16
    for k in got:
        assert got[k] == pytest.approx(want[k], rel=1e-12, abs=0), k


def test_small_and_empty_groups(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 1.0), (2, 3.0), (3, None), (4, math.inf), (4, 1.0), (4, -math.inf), (4, 2.0), (4, 7.0)], "c int, x double")
    got, _ = both(spark, df, ["x"], ["c"])
    assert got[(1, "x")] == [5.0] * 6 and got[(2, "x")][2] == 2.0 and (3, "x") not in got
    assert got[(4, "x")][2] == 2.0 and got[(4, "x")][0] == -math.inf and got[(4, "x")][5] == math.inf
    assert Q.exact_quantiles(df.limit(0), ["x"], ["c"], QS).count() == 0


def test_without_groups(spark):
    df = spark.range(101).select((F.col("id") * 0.1).alias("x"))
    r = Q.exact_quantiles(df, ["x"], [], [0.5, 0.95]).first()
    assert r["q"] == pytest.approx([5.0, 9.5])
