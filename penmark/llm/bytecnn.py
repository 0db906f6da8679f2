"""Language identification by a convolutional network over bytes.

A text's UTF-8 bytes are cut into windows of fixed length (the last one
padded).  Each byte is embedded; filters of several widths slide over a
window, their maximum over positions passes a ReLU and feeds a softmax over
the languages.  A text's probabilities are the mean over all its windows.

Applying a filter to embedded bytes is a sum of table rows, one table per
offset, so inference looks up pairs of bytes in precomputed tables.

Defined results: ``und`` with score 0 for a null text or one without a letter
(Unicode category L), and when there is no labelled text to learn from; every
window of a very long text is read; of equally likely languages the first by name;
repeated rows get equal results; an empty table gives none; extra columns stay.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from penmark.llm.common import added, bounded_sample

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
ASCII_LETTER = re.compile("[A-Za-z]")
UND = "und"


@dataclass
class ByteCnn:
    languages: list[str]
    embed: np.ndarray                       # 256 x EMBED
    filters: list[np.ndarray]               # per width: width x EMBED x FILTERS
    shift: np.ndarray                       # all filters
    out: np.ndarray                         # all filters x languages
    bias: np.ndarray
    tables: list = field(default_factory=list, repr=False)

    def prepare(self) -> "ByteCnn":
        """Per width: tables of byte pairs (65536 rows) and an odd last byte."""
        e = self.embed
        for f in self.filters:
            single = [(e @ w).astype(np.float32) for w in f]
            pairs = [(single[j][:, None, :] + single[j + 1][None, :, :]).reshape(65536, -1)
                     for j in range(0, len(f) - 1, 2)]
            self.tables.append((len(f), pairs, single[-1] if len(f) % 2 else None))
        return self

    def windows(self, x: np.ndarray) -> np.ndarray:
        """Softmax for each row of ``x`` (windows x WINDOW, uint8)."""
        pair = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        top = []
        for width, pairs, last in self.tables:
            n = x.shape[1] - width + 1
            z = pairs[0][pair[:, :n]]
            for j, t in enumerate(pairs[1:], 1):
                z += t[pair[:, 2 * j:2 * j + n]]
            if last is not None:
                z += last[x[:, width - 1:width - 1 + n]]
            top.append(z.max(1))
        h = np.maximum(np.concatenate(top, 1) + self.shift, 0)
        s = h @ self.out + self.bias
        s = np.exp(s - s.max(1, keepdims=True))
        return s / s.sum(1, keepdims=True)


def cut(data: bytes, window: int = WINDOW) -> np.ndarray:
    """All windows of a text; a short rest is padded with blanks unless it is
    under a quarter of a window and others stand before it, when the last full
    stretch is read again from the end."""
    n = len(data)
    if n <= window:
        return np.frombuffer(data.ljust(window), np.uint8).reshape(1, window)
    full = n // window
    rows = np.frombuffer(data, np.uint8, full * window).reshape(full, window)
    if n % window:
        rows = np.concatenate((rows, np.frombuffer(data[-window:], np.uint8)[None, :]))
    return rows


def fit(texts: list[str], langs: list[str], epochs: int = 6, batch: int = 64, rate: float = 3e-3,
        per_text: int = 3, seed: int = 11) -> ByteCnn | None:
    """Adam on cross-entropy over a few windows of each training text."""
    rng = np.random.default_rng(seed)
    names = sorted(set(langs))
    if not names:
        return None
    xs, ys = [], []
    for t, lang in zip(texts, langs):
        w = cut(t.encode("utf-8", "replace"))
        pick = w[rng.permutation(len(w))[:per_text]]
        xs.append(pick)
        ys += [names.index(lang)] * len(pick)
    x, y = np.concatenate(xs), np.array(ys)
    k, c = len(names), FILTERS * len(WIDTHS)
    par = {"e": rng.normal(0, 0.3, (256, EMBED)), "s": np.zeros(c), "o": rng.normal(0, 0.2, (c, k)), "b": np.zeros(k)}
    for w in WIDTHS:
        par[f"f{w}"] = rng.normal(0, 1 / np.sqrt(w * EMBED), (w, EMBED, FILTERS))
    m1, m2 = {a: np.zeros_like(v) for a, v in par.items()}, {a: np.zeros_like(v) for a, v in par.items()}
    step = 0
    for _ in range(epochs if k > 1 else 0):
        order = rng.permutation(len(x))
        for lo in range(0, len(x), batch):
            i = order[lo:lo + batch]
            xb, yb, n = x[i], y[i], len(i)
            emb = par["e"][xb]
            tops, where = [], []
            for w in WIDTHS:
                span = WINDOW - w + 1
                z = sum(emb[:, j:j + span] @ par[f"f{w}"][j] for j in range(w))
                at = z.argmax(1)
                where.append(at)
                tops.append(np.take_along_axis(z, at[:, None, :], 1)[:, 0])
            pre = np.concatenate(tops, 1) + par["s"]
            h = np.maximum(pre, 0)
            s = h @ par["o"] + par["b"]
            p = np.exp(s - s.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            g = p.copy()
            g[np.arange(n), yb] -= 1
            g /= n
            grad = {"o": h.T @ g, "b": g.sum(0)}
            gh = (g @ par["o"].T) * (pre > 0)
            grad["s"], ge = gh.sum(0), np.zeros_like(par["e"])
            for q, w in enumerate(WIDTHS):
                gz, at = gh[:, q * FILTERS:(q + 1) * FILTERS], where[q]
                gf = np.zeros_like(par[f"f{w}"])
                for j in range(w):
                    byte = np.take_along_axis(xb, at + j, 1)              # n x FILTERS
                    gf[j] = np.einsum("nf,nfe->ef", gz, par["e"][byte])
                    np.add.at(ge, byte.ravel(), (gz[:, :, None] * par[f"f{w}"][j].T[None]).reshape(-1, EMBED))
                grad[f"f{w}"] = gf
            grad["e"] = ge
            step += 1
            for a, v in par.items():
                m1[a] = 0.9 * m1[a] + 0.1 * grad[a]
                m2[a] = 0.999 * m2[a] + 0.001 * grad[a] ** 2
                v -= rate * (m1[a] / (1 - 0.9 ** step)) / (np.sqrt(m2[a] / (1 - 0.999 ** step)) + 1e-8)
    f32 = {a: v.astype(np.float32) for a, v in par.items()}
    return ByteCnn(names, f32["e"], [f32[f"f{w}"] for w in WIDTHS], f32["s"], f32["o"], f32["b"])


def train(docs: DataFrame, max_docs: int = 4000, text_col: str = "text", lang_col: str = "lang") -> ByteCnn | None:
    """Model from texts with a language.  ``max_docs`` bounds the sample on the
    driver: an equal share for each language (at least 50), distinct texts,
    smallest hash first; of each, ``fit`` reads ``per_text`` (3) random windows."""
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    names = sorted(r[0] for r in rows.select("lang").distinct().collect())
    got = []
    for name in names:
        part = bounded_sample(rows.where(F.col("lang") == name).select("text"), "text",
                              max(50, max_docs // len(names)))
        got += [(r[0], name) for r in part.collect()]
    return fit([t for t, _ in got], [g for _, g in got])


def has_letter(text: str) -> bool:
    """Whether a character is of Unicode category L, as the training's ``\\p{L}``."""
    return bool(ASCII_LETTER.search(text)) or any(map(str.isalpha, text))


def predict_udf(docs: DataFrame, model: ByteCnn | None, step: int = 256):
    """Scalar UDF: text -> struct(lang_pred, score); every window of a text is
    read, ``step`` windows at a time."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("lang_pred string, score double")
    def predict(text: pd.Series) -> pd.DataFrame:
        m = shared.value
        if m is not None and not m.tables:
            m.prepare()
        names, scores = [UND] * len(text), np.zeros(len(text))
        part, owner = [], []
        total = np.zeros((len(text), len(m.languages) if m else 0))
        count = np.zeros(len(text))

        def flush():
            x, o = np.concatenate(part), np.concatenate(owner)
            for lo in range(0, len(x), step):
                np.add.at(total, o[lo:lo + step], m.windows(x[lo:lo + step]))
            np.add.at(count, o, 1)
            part.clear()
            owner.clear()

        size = 0
        for i, t in enumerate(text.tolist()):
            if m is None or not isinstance(t, str) or not has_letter(t):
                continue
            w = cut(t.encode("utf-8", "replace"))
            part.append(w)
            owner.append(np.full(len(w), i))
            size += len(w)
            if size >= 4 * step:
                flush()
                size = 0
        if part:
            flush()
        for i in np.flatnonzero(count):
            p = total[i] / count[i]
            names[i], scores[i] = m.languages[int(p.argmax())], float(p.max())
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return predict


def predict(docs: DataFrame, model: ByteCnn | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``language`` (lang_pred, score) added; if the caller has a column
    of that name it stays and ours is ``language_``."""
    return docs.withColumn(added(docs, "language"), predict_udf(docs, model)(F.col(text_col)))
