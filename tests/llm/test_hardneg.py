"""Residue products and mined negatives against plain integer arithmetic."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from penmark.llm import hardneg

SCHEMA = "vec_id long, label int, embedding array<float>, anchor_id int, score string, c string, found int, down int"


def frame(spark, rows):
    return spark.createDataFrame([(i, y, v, 1, "s", "c", 2, 3) for i, y, v in rows], SCHEMA)


def brute(rows, n_pos=5, n_neg=3, low=50, high=95):
    ok = {}
    dims = [len(v) for _, y, v in rows if y is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    dim = max(sorted(set(dims)), key=dims.count, default=0)
    for i, y, v in rows:
        if i is None or y is None or not v or len(v) != dim or any(x is None or not math.isfinite(x) for x in v):
            continue
        c = (y, [math.floor(256 * float(np.float32(x))) for x in v])
        ok[i] = min(ok.get(i, c), c)
    out = []
    for a in sorted(ok):
        if a % 5:
            continue
        s = sorted((-sum(x * y for x, y in zip(ok[a][1], ok[b][1])), b) for b in ok if b != a)
        for p, pid in [x for x in s if ok[x[1]][0] == ok[a][0]][:n_pos]:
            inside = [(n, b) for n, b in s if ok[b][0] != ok[a][0] and low * -p <= 100 * -n <= high * -p]
            out += [(a, pid, r + 1, b, -p, -n) for r, (n, b) in enumerate(inside[:n_neg])]
    return sorted(out)


def mined(spark, rows, **kw):
    return sorted(tuple(r) for r in hardneg.mine(frame(spark, rows), F.col("vec_id") % 5 == 0, **kw).collect())


@pytest.mark.parametrize("dim,size", [(1, 1 << 20), (3, 1 << 26), (64, 300), (64, 1 << 24), (5000, 1 << 20)])
def test_residue_products_are_exact(dim, size):
    rng = np.random.default_rng(dim)
    a, c = (rng.integers(-size, size + 1, (n, dim)) for n in (7, 9))
    a[0], c[0] = size, -size                     # the extreme score
    bound = max(int((x.astype(object) ** 2).sum(1).max()) for x in (a, c))
    primes = hardneg.primes_for(dim, bound)
    got = hardneg.scores(hardneg.residues(a, primes), hardneg.residues(c, primes), primes)
    assert (got == a @ c.T).all()


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(3)), [float(x) for x in rng.normal(0, 0.3, 6)]) for i in range(120)]
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, rows, n_positives=2, n_negatives=7, low=0, high=100) == brute(rows, 2, 7, 0, 100)


def test_many_strips_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, 0 if i % 3 else i % 7, [float(x) for x in rng.normal(0, 0.3, 4)]) for i in range(150)]
    for name, v in (("ROW_BYTES", 1000), ("ANCHOR_BYTES", 300), ("BLOCK_ROWS", 7), ("BLOCK_ANCHORS", 3)):
        monkeypatch.setattr(hardneg, name, v)
    assert mined(spark, rows) == brute(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, 1, [0.5, 0.5]), (6, 1, [0.5, 0.5]), (7, 1, [0.5, 0.5]), (8, 2, [0.25, 0.5]), (9, 2, [0.25, 0.5]),
            (9, 2, [0.25, 0.5]), (6, 1, [0.5, 0.5]),                       # repeated rows
            (11, 2, [0.3, 0.5]), (11, 2, [0.2, 0.5]),                      # one id, two contents
            (None, 2, [0.4, 0.4]), (12, None, [0.4, 0.4]), (13, 2, None), (14, 2, [0.4, None]), (16, 2, [0.4, nan]),
            (17, 2, [inf, 0.4]), (18, 2, [0.4, 0.4, 0.4]), (19, 2, []),
            (15, 7, [0.4, 0.4]),                                           # an anchor alone in its label
            (20, 3, [0.0, 0.0]), (21, 3, [0.0, 0.0])]                      # scores of zero
    want = brute(rows)
    assert mined(spark, rows) == want
    assert [r[3] for r in want if r[0] == 5 and r[1] == 6] == [15, 8, 9]
    assert not any(r[0] == 15 for r in want) and any(r[0] == 20 for r in want)
    assert mined(spark, []) == []
    assert mined(spark, [(5, None, None)]) == []
    with pytest.raises(ValueError):
        mined(spark, [(5, 1, [1e30, 1.0]), (6, 1, [1.0, 1.0])])


def test_equal_vectors_in_a_large_group(spark):
    rows = [(i, i % 2, [0.3, -0.2, 0.1]) for i in range(400)] + [(i, i % 2, [0.2, -0.2, 0.1]) for i in range(400, 420)]
    assert mined(spark, rows) == brute(rows)
