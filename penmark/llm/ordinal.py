"""Quality by ordinal cumulative-link regression.

Grades 0..K-1 share one weight vector over hashed words and word shapes;
ordered thresholds cut its score: ``P(grade > k) = sigmoid(w.x - theta_k)``.
The expected grade and a tail probability follow for every document.

Defined results: a null or empty text has the all-zero feature vector and gets
the grades' base rates from the thresholds; with fewer than two grades to
learn from, every document gets that grade with certainty (0 without any).
Repeated rows get equal results; very long texts are read whole; a text at equal
probabilities counts to the lower grade's side of ``select_at`` only below it; an
empty table gives none; extra columns stay.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from penmark.llm.common import added, by_bytes, labelled_sample

N_BUCKETS = 1 << 16
WORD = re.compile(r"\S+")
_LETTERS, _DIGITS = re.compile(r"[^\W\d_]+"), re.compile(r"\d+")


@dataclass
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray          # K - 1, ascending
    grades: list[float]

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade index > k) for k = 0..K-2, one row per document."""
        z = np.clip(score[:, None] - self.thresholds[None, :], -30, 30)
        return 1 / (1 + np.exp(-z))


class Shapes(dict):
    """Token -> its two buckets: its shape (letter case, digits, marks) in the
    lower half, the lower-cased word in the upper half."""

    def __init__(self, n_buckets: int, most: int = 100_000):
        super().__init__()
        self.n, self.most = n_buckets, most

    def __missing__(self, token: str) -> tuple[int, int]:
        if len(self) >= self.most:
            self.clear()
        half = self.n // 2
        shape = _DIGITS.sub("9", _LETTERS.sub(lambda m: "A" if m.group().isupper() and len(m.group()) > 1 else "a", token))
        v = self[token] = (zlib.crc32(shape.encode("utf-8", "surrogatepass")) % half,
                           half + zlib.crc32(token.lower().encode("utf-8", "surrogatepass")) % half)
        return v


def features(texts: list[str | None], cache: Shapes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, value) of the hashed counts, square-rooted and scaled to
    unit length per text and kind."""
    flat, lens = [], []
    for t in texts:
        toks = WORD.findall(t) if t else []
        flat += [x for w in toks for x in cache[w]]
        lens.append(2 * len(toks))
    doc = np.repeat(np.arange(len(texts)), lens)
    if not len(doc):
        return doc, doc, doc.astype(float)
    key, n = np.unique(doc * cache.n + np.array(flat, np.int64), return_counts=True)
    doc, ids, val = key // cache.n, key % cache.n, np.sqrt(n)
    kind = doc * 2 + (ids >= cache.n // 2)
    norm = np.sqrt(np.bincount(kind, weights=val * val))
    return doc, ids, val / norm[kind]


def fit(texts: list[str], grade: np.ndarray, grades: list[float], rounds: int = 150, rate: float = 0.3,
        l2: float = 1e-4, n_buckets: int = N_BUCKETS) -> Ordinal:
    """AdaGrad on the cumulative-link log-likelihood.  Gaps between thresholds
    are exponentials of free parameters, so they stay ordered."""
    k = len(grades)
    if k < 2:
        return Ordinal(np.zeros(n_buckets), np.zeros(0), grades or [0.0])
    doc, ids, val = features(texts, Shapes(n_buckets))
    used, ids = np.unique(ids, return_inverse=True)
    w = np.zeros(len(used))
    share = np.array([(grade > j).mean() for j in range(k - 1)]).clip(1e-3, 1 - 1e-3)
    start = -np.log(share / (1 - share))
    first, gap = start[0], np.log(np.maximum(np.diff(start), 1e-2))
    gw, gf, gg = np.full(len(used), 1e-8), 1e-8, np.full(k - 1, 1e-8)[1:]
    n = len(texts)
    for _ in range(rounds):
        theta = first + np.concatenate(([0.0], np.cumsum(np.exp(gap))))
        s = np.bincount(doc, weights=w[ids] * val, minlength=n)
        up = 1 / (1 + np.exp(-np.clip(s[:, None] - theta[None, :], -30, 30)))
        # P(g) = up[g-1] - up[g]; gradients of log P(g) by s and theta
        hi = np.concatenate((np.ones((n, 1)), up), 1)
        lo = np.concatenate((up, np.zeros((n, 1))), 1)
        r = np.arange(n)
        a, b = hi[r, grade], lo[r, grade]
        p = np.maximum(a - b, 1e-9)
        da, db = a * (1 - a), b * (1 - b)
        gs = (da - db) / p / n
        gt = np.zeros(k - 1)
        np.add.at(gt, np.maximum(grade - 1, 0), np.where(grade > 0, -da / p, 0) / n)
        np.add.at(gt, np.minimum(grade, k - 2), np.where(grade < k - 1, db / p, 0) / n)
        grad = np.bincount(ids, weights=gs[doc] * val, minlength=len(used)) - l2 * w / n
        gw += grad * grad
        w += rate * grad / np.sqrt(gw)
        gf += gt.sum() ** 2
        first += rate * gt.sum() / np.sqrt(gf)
        if k > 2:
            ggap = np.array([gt[j:].sum() for j in range(1, k - 1)]) * np.exp(gap)
            gg += ggap ** 2
            gap += rate * ggap / np.sqrt(gg)
    weights = np.zeros(n_buckets)
    weights[used] = w
    return Ordinal(weights, first + np.concatenate(([0.0], np.cumsum(np.exp(gap)))), grades)


def train(docs: DataFrame, ratings: DataFrame, rating: F.Column | str, max_docs: int = 3000,
          id_col: str = "doc_id", text_col: str = "text") -> Ordinal:
    """Model from rated documents.  ``max_docs`` bounds the sample on the
    driver: an equal share for each grade, distinct texts, smallest hash first.  The
    number of grades is taken to be small (it is the rating scale)."""
    rate = F.col(rating) if isinstance(rating, str) else rating
    lab = (ratings.select(F.col(id_col).alias("__pm_id"), rate.cast("double").alias("__pm_y"))
           .where("__pm_id is not null and __pm_y is not null").groupBy("__pm_id").agg(F.max("__pm_y").alias("__pm_y")))
    got = labelled_sample(docs, lab, lambda n: max_docs // n, id_col, text_col)
    grades = sorted({y for y, _ in got})
    return fit([t for _, t in got], np.array([grades.index(y) for y, _ in got], np.int64), grades)


def score_udf(docs: DataFrame, model: Ordinal, tail_at: int = 0):
    """Scalar UDF: text -> struct(expected grade, P(grade index > tail_at))."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds, model.grades))

    @pandas_udf("expected_grade double, tail_prob double")
    def score(text: pd.Series) -> pd.DataFrame:
        w, theta, grades = shared.value
        m, cache = Ordinal(w, theta, grades), _CACHE.setdefault(len(w), Shapes(len(w)))
        texts = [t if isinstance(t, str) else None for t in text.tolist()]
        exp, tail = np.full(len(texts), float(grades[0])), np.full(len(texts), float(len(grades) == 1))
        for lo, hi in by_bytes(texts):
            if len(grades) > 1:
                doc, ids, val = features(texts[lo:hi], cache)
                up = m.tails(np.bincount(doc, weights=m.weights[ids] * val, minlength=hi - lo))
                exp[lo:hi] = grades[0] + up @ np.diff(grades)
                tail[lo:hi] = up[:, tail_at]
        return pd.DataFrame({"expected_grade": exp, "tail_prob": tail})

    return score


_CACHE: dict[int, Shapes] = {}


def score(docs: DataFrame, model: Ordinal, text_col: str = "text", tail_at: int = 0,
          select_at: float = 0.5) -> DataFrame:
    """``docs`` with ``quality`` (expected_grade, tail_prob) and ``selected``
    (tail_prob >= ``select_at``) added; a caller's columns of these names stay and
    ours are ``quality_`` and ``selected_``."""
    q, sel = added(docs, "quality"), added(docs, "selected")
    out = docs.withColumn(q, score_udf(docs, model, tail_at)(F.col(text_col)))
    return out.withColumn(sel, F.col(q)["tail_prob"] >= select_at)
