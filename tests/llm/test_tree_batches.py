"""Queries that go down a vantage-point tree together."""

import numpy as np

from penmark.llm import vptree


def test_queries_share_a_descent_and_stay_exact(monkeypatch):
    """Few pairs are scored one by one, and the answer is the brute-force one, ties and own ids included."""
    rng = np.random.default_rng(3)
    v = rng.normal(size=(1500, 24))
    ids = [[10 * i, 10 * i + 1] if i % 9 == 0 else [10 * i] for i in range(len(v))]
    qid = np.arange(0, 3000, 10)
    q = v[qid // 10]
    scored, whole = [], vptree.pair_cosines
    monkeypatch.setattr(vptree, "pair_cosines", lambda a, b: scored.append(len(a)) or whole(a, b))
    at, found, score = vptree.Tree(v, ids).search(q, qid, 5, 1.0)
    assert sum(scored) < len(v) * len(q) / 4
    for i in range(len(q)):
        s = vptree.cosines(v, q[i])
        best = sorted((-s[j], x) for j in range(len(v)) for x in ids[j] if x != qid[i])[:5]
        assert list(zip((-score[at == i]).tolist(), found[at == i].tolist())) == [(float(a), x) for a, x in best]


def test_fewer_rows_than_wanted():
    v = np.array([[1.0, 0.0], [0.0, 2.0], [1e300, 1e300]])
    at, found, score = vptree.Tree(v, [[1], [2], [3]]).search(v[:1], np.array([1]), 5, 1.0)
    assert at.tolist() == [0, 0] and found.tolist() == [3, 2] and score[1] == 0.0
