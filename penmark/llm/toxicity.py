"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence's probability is a logistic
function of its hashed words and their first letters (so that inflected forms
share what is learned); the document's is their noisy-or, ``1 - prod(1 - p)``.  Only document labels are needed to train, and the
sentence probabilities then say where the offence is.

Defined results: a null or empty text has no sentence and scores 0; rows that
repeat get the same score; extra columns are passed through; without both
labels among the training rows every score is 0; very long texts are read whole;
an empty table gives none.
"""

from __future__ import annotations

import re
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from penmark.llm.common import added, by_bytes, labelled_sample

#: A word (letters only) or a run of sentence ends.
TOKEN = re.compile(r"[^\W\d_]+|[.!?\n]+")
SENTENCE = re.compile(r"[^.!?\n]+[.!?\n]*")
ENDS = frozenset(".!?\n")
N_BUCKETS = 1 << 18
THRESHOLD = 0.7


#: Lengths of the word starts that are features beside the whole word.
STARTS = (4, 5)
PER_WORD = 1 + len(STARTS)


def buckets(word: str) -> tuple[int, ...]:
    """The word's own bucket and those of its starts."""
    w = word.encode("utf-8", "surrogatepass")
    return (zlib.crc32(w) % N_BUCKETS, *(zlib.crc32(f"{n}^{word[:n]}".encode("utf-8", "surrogatepass")) % N_BUCKETS
                                         for n in STARTS))


class WordWeights(dict):
    """Word -> its part of a sentence's logit; emptied at ``most`` words."""

    def __init__(self, weights: np.ndarray, most: int = 100_000):
        super().__init__()
        self.weights, self.most = weights, most

    def __missing__(self, word: str) -> float:
        if len(self) >= self.most:
            self.clear()
        v = self[word] = float(sum(self.weights[i] for i in buckets(word)))
        return v


@dataclass
class NoisyOr:
    weights: np.ndarray
    bias: float

    def sentences(self, logits: np.ndarray, sent: np.ndarray, n: int) -> np.ndarray:
        z = np.bincount(sent, weights=logits, minlength=n) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def bags(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words, the sentence of each word, and the text of each sentence
    (sentences without words are left out)."""
    tokens, lens = [], []
    for t in texts:
        found = TOKEN.findall(t.lower()) if t else []
        tokens += found
        lens.append(len(found))
    doc = np.repeat(np.arange(len(texts)), lens)
    end = np.fromiter((w[0] in ENDS for w in tokens), bool, len(tokens))
    words = [w for w, e in zip(tokens, end.tolist()) if not e]
    if not words:
        return [], np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = end.copy()
    new[1:] |= doc[1:] != doc[:-1]
    raw, doc = np.cumsum(new)[~end], doc[~end]
    first = np.concatenate(([True], raw[1:] != raw[:-1]))
    return words, np.cumsum(first) - 1, doc[first]


def fit(texts: list[str], y: np.ndarray, rounds: int = 200, rate: float = 2.0, evidence: float = 1.0,
        min_docs: int = 3) -> NoisyOr:
    """Full-batch gradient ascent with momentum on the noisy-or likelihood of the
    document labels; a plain gradient lets words of many toxic documents outrun
    chance words, which scaled steps would not, and an L1 penalty worth
    ``evidence`` documents keeps the latter at 0.  Buckets of fewer than ``min_docs`` documents keep the weight 0."""
    model = NoisyOr(np.zeros(N_BUCKETS, np.float32), -30.0)
    y = np.asarray(y, float)
    words, sent, sdoc = bags(texts)
    if len(set(y.tolist())) < 2 or not words:
        return model
    known: dict[str, tuple] = {}
    ids = np.array([known.get(w) or known.setdefault(w, buckets(w)) for w in words], np.int32).ravel()
    sent = np.repeat(sent.astype(np.int32), PER_WORD)
    n, n_docs = len(sdoc), len(y)
    pair = np.unique(ids.astype(np.int64) * n_docs + sdoc[sent])
    keep = np.bincount(pair // n_docs, minlength=N_BUCKETS) >= min_docs
    sent, ids = sent[keep[ids]], ids[keep[ids]]
    used, ids = np.unique(ids, return_inverse=True)
    ids = ids.astype(np.int32)
    w, b, vw, vb = np.zeros(len(used)), -4.0, np.zeros(len(used)), 0.0
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    shrink = 0.5 * evidence / max(1, y.sum())
    for _ in range(rounds):
        z = np.clip(np.bincount(sent, weights=w[ids], minlength=n) + b, -30, 30)
        p = 1 / (1 + np.exp(-z))
        log_none = np.bincount(sdoc, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=n_docs)
        doc_p = np.clip(-np.expm1(log_none), 1e-9, 1.0)
        # d log-likelihood / dz: p (1 - P) / P for a toxic document, -p for a clean one
        g = np.where(y[sdoc] == 1, p * (1 - doc_p[sdoc]) / doc_p[sdoc], -p) * weight[sdoc]
        vw = 0.9 * vw + np.bincount(ids, weights=g[sent], minlength=len(used))
        vb = 0.9 * vb + g.sum()
        w += rate * vw
        w = np.sign(w) * np.maximum(np.abs(w) - 10 * rate * shrink, 0)
        b += rate / 100 * vb
    model.weights[used] = w
    model.bias = float(b)
    return model


def train(docs: DataFrame, labels: DataFrame, max_docs: int = 3000, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic") -> NoisyOr:
    """Model from the documents that have a label.

    ``max_docs`` bounds the sample that reaches the driver: half of it for each
    label, the distinct texts with the smallest hash.
    """
    lab = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
           .groupBy(F.col(id_col).alias("__pm_id")).agg(F.max(F.col(label_col)).cast("int").alias("__pm_y")))
    got = labelled_sample(docs, lab, lambda n: max_docs // 2, id_col, text_col)
    got = [(t, y) for value in (1, 0) for y, t in got if y == value]
    return fit([t for t, _ in got], np.array([v for _, v in got]))


def score_udf(docs: DataFrame, model: NoisyOr):
    """Scalar UDF: text -> struct(score, spans of sentences at 0.5 or more)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    name = uuid.uuid4().hex

    @pandas_udf("score double, spans array<struct<start:int,length:int,p:double>>")
    def score(text: pd.Series) -> pd.DataFrame:
        m = NoisyOr(*shared.value)
        weight = _weights(name, m)
        texts = [t if isinstance(t, str) else None for t in text]
        scores, spans = np.zeros(len(texts)), [[] for _ in texts]
        for lo, hi in by_bytes(texts):
            words, sent, sdoc = bags(texts[lo:hi])
            if not words:
                continue
            logits = np.fromiter(map(weight.__getitem__, words), float, len(words))
            p = m.sentences(logits, sent, len(sdoc))
            none = np.bincount(sdoc, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=hi - lo)
            scores[lo:hi] = -np.expm1(none)
            for d in np.unique(sdoc[p >= 0.5]):
                spans[lo + d] = locate(texts[lo + d], m, weight)
        return pd.DataFrame({"score": scores, "spans": spans})

    return score


_WEIGHTS: dict[str, WordWeights] = {}


def _weights(key: str, model: NoisyOr) -> WordWeights:
    """A worker's word cache for the broadcast model; only the last one stays."""
    if key not in _WEIGHTS:
        _WEIGHTS.clear()
        _WEIGHTS[key] = WordWeights(model.weights)
    return _WEIGHTS[key]


def locate(text: str, model: NoisyOr, weight: WordWeights, at: float = 0.5) -> list[dict]:
    """Character spans of the sentences whose probability is ``at`` or more."""
    out = []
    for s in SENTENCE.finditer(text):
        words = [w for w in TOKEN.findall(s.group().lower()) if w[0] not in ENDS]
        if words:
            p = float(model.sentences(np.array([weight[w] for w in words]), np.zeros(len(words), np.int64), 1)[0])
            if p >= at:
                out.append({"start": s.start(), "length": s.end() - s.start(), "p": p})
    return out


def score(docs: DataFrame, model: NoisyOr, text_col: str = "text") -> DataFrame:
    """``docs`` with ``toxicity`` (score, spans) added; if the caller has a column of
    that name it stays and ours is ``toxicity_``."""
    return docs.withColumn(added(docs, "toxicity"), score_udf(docs, model)(F.col(text_col)))
