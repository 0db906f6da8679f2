"""Record scoring with a caller's model in bounded, padded batches.

The caller gives a loader (called once in a worker), an encoder (text to token
ids) and a function from a padded matrix of ids and its mask to class
probabilities.  Rows are taken in windows; a window's rows are ordered by length
bucket (powers of two) and cut into batches whose padded size stays within
``max_tokens``, so a batch wastes less than half its cells and memory is bounded
by the batch.  Results come back in the rows' own order.

A row longer than ``max_tokens`` is a batch of its own; a missing text is encoded
as the empty text; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Padded tokens a model sees at once, and rows and characters that are held to be ordered by length.
MAX_TOKENS = 1 << 15
WINDOW_ROWS, WINDOW_CHARS = 4096, 8 << 20


@dataclass(frozen=True)
class RecordModel:
    load: Callable[[], Any]
    encode: Callable[[Any, str], Sequence[int]]
    predict: Callable[[Any, np.ndarray, np.ndarray], np.ndarray]      # (model, ids, mask) -> rows x classes


def length_batches(sizes: Sequence[int], max_tokens: int) -> list[list[int]]:
    """Rows grouped by length bucket, no batch above ``max_tokens`` once padded
    (a longer row stands alone)."""
    bucket = [max(1, s - 1).bit_length() for s in sizes]
    out, rows, widest = [], [], 0
    for i in sorted(range(len(sizes)), key=lambda i: (bucket[i], i)):
        wide = max(widest, sizes[i], 1)
        if rows and (bucket[i] != bucket[rows[0]] or wide * (len(rows) + 1) > max_tokens):
            out.append(rows)
            rows, wide = [], max(sizes[i], 1)
        rows.append(i)
        widest = wide
    return [*out, rows] if rows else out


def predict_texts(model: RecordModel, state: Any, texts: Sequence[str | None], max_tokens: int) -> list[np.ndarray]:
    ids = [np.asarray(model.encode(state, t or ""), np.int64) for t in texts]
    out: list[Any] = [None] * len(ids)
    for rows in length_batches([len(x) for x in ids], max_tokens):
        width = max(1, max(len(ids[i]) for i in rows))
        padded, mask = np.zeros((len(rows), width), np.int64), np.zeros((len(rows), width), bool)
        for r, i in enumerate(rows):
            padded[r, :len(ids[i])], mask[r, :len(ids[i])] = ids[i], True
        for i, p in zip(rows, np.asarray(model.predict(state, padded, mask), float)):
            out[i] = p
    return out


def windows(texts: Sequence[str | None], rows: int, chars: int):
    a = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= chars or i + 1 - a >= rows:
            yield a, i + 1
            a, size = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


def score_records(df: DataFrame, text_col: str, model: RecordModel, out: str = "probabilities", max_tokens: int = MAX_TOKENS) -> DataFrame:
    """``df`` with the class probabilities of each row's text as an array."""
    at = df.columns.index(text_col)

    def run(batches):
        state = None
        for b in batches:
            if state is None:
                state = model.load()
            texts = b.column(at).to_pylist()
            for lo, hi in windows(texts, WINDOW_ROWS, WINDOW_CHARS):
                probs = predict_texts(model, state, texts[lo:hi], max_tokens)
                part = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([p.tolist() for p in probs], pa.list_(pa.float64()))],
                                                 names=[*part.schema.names, out])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))]))


def labelled(df: DataFrame, labels: Sequence[str], probs: str = "probabilities", out: str = "prediction") -> DataFrame:
    """``df`` with the label of the largest probability (the first of equal ones)."""
    p = F.col(probs)
    return df.withColumn(out, F.element_at(F.array(*[F.lit(x) for x in labels]), F.array_position(p, F.array_max(p)).cast("int")))
