"""Text classifier trained by epochs: warm-up, linear decay, best epoch kept.

Texts become sparse hashed counts, packed once into blocks.  An epoch is one
shared pass of mini-batch Adam steps with decoupled weight decay (``passes``);
after it the validation loss is measured, and the state, with the losses so far
and the best weights, is saved in the shared folder.  A run that finds saved
epochs goes on after the last of them and ends exactly as one that was never
stopped.  Training ends after ``epochs``, or once the validation loss has not
fallen for ``patience`` epochs; the weights of the best epoch are returned.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penmark.operators import passes
from penmark.operators.passes import Adam
from penmark.operators.textmodel import TOKEN, Buckets, softmax
from penmark.session import cut_lineage

# The reference's three epochs, batches of 8, 500 warm-up steps, weight decay 0.01.
EPOCHS, BATCH, WARM_UP, DECAY = 3, 8, 500, 0.01
BUCKETS = 1 << 14
RATE = 0.01


@dataclass(frozen=True)
class Schedule:
    """Step size's factor: linear up over ``warm_up`` steps, then linear down to 0 at ``total``."""
    warm_up: int
    total: int

    def __call__(self, step: int) -> float:
        if step <= self.warm_up:
            return step / max(1, self.warm_up)
        return max(0.0, (self.total - step) / max(1, self.total - self.warm_up))


@dataclass(frozen=True)
class LinearText:
    """Softmax over hashed, length-scaled token counts; the last row of weights is the shift."""
    buckets: int
    classes: int
    rate: float

    def start(self) -> np.ndarray:
        return np.zeros((self.buckets + 1) * self.classes)

    def scores(self, p: np.ndarray, row: np.ndarray, at: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        w = p.reshape(-1, self.classes)
        z = np.tile(w[-1], (n, 1))
        np.add.at(z, row, w[at] * value[:, None])
        return softmax(z)

    def gradient(self, p: np.ndarray, block: dict, rows: np.ndarray) -> tuple[float, np.ndarray]:
        if "_begin" not in block:
            size = block["bucket_size"]
            block["_begin"] = np.cumsum(size) - size
        size = block["bucket_size"][rows]
        row = np.repeat(np.arange(len(rows)), size)
        i = np.concatenate([np.arange(b, b + s) for b, s in zip(block["_begin"][rows], size)] or [np.zeros(0, int)]).astype(int)
        at, value, y = block["bucket"][i].astype(int), block["weight"][i], block["label_idx"][rows].astype(int)
        prob = self.scores(p, row, at, value, len(rows))
        loss = -np.log(np.maximum(prob[np.arange(len(rows)), y], 1e-300)).mean()
        prob[np.arange(len(rows)), y] -= 1
        prob /= len(rows)
        g = np.zeros((self.buckets + 1, self.classes))
        np.add.at(g, at, prob[row] * value[:, None])
        g[-1] = prob.sum(0)
        return float(loss), g.ravel()


@dataclass
class EpochModel:
    labels: list[str]
    kernel: LinearText
    weights: np.ndarray
    best_epoch: int
    train_losses: list[float]
    val_losses: list[float]


def counted_udf(buckets: int):
    """Scalar UDF: lower-cased text -> its buckets, ascending, and their counts over the
    root of their squared sum.  A text's time is in proportion to its tokens."""
    known: list[Buckets] = []

    @F.pandas_udf("bucket array<int>, weight array<double>")
    def count(text: pd.Series) -> pd.DataFrame:
        if not known:
            known.append(Buckets(buckets))
        at, kinds, weights = known[0], [], []
        for t in text:
            found = Counter(TOKEN.findall(t) if isinstance(t, str) else ())
            kind, which = np.unique(np.fromiter((at[w] for w in found), np.int32, len(found)), return_inverse=True)
            n = np.bincount(which, weights=np.fromiter(found.values(), float, len(found)), minlength=len(kind))
            kinds.append(kind)
            weights.append(n / np.sqrt((n * n).sum()))
        return pd.DataFrame({"bucket": pd.Series(kinds, dtype=object), "weight": pd.Series(weights, dtype=object)})

    return count


def hashed(df: DataFrame, key: str, text_col: str, label_col: str | None, labels: Sequence[str], buckets: int) -> DataFrame:
    """(row_key, label_idx, bucket array, weight array): counts over the root of their squared sum."""
    lab = F.array(*[F.lit(x) for x in labels])
    idx = (F.array_position(lab, F.col(label_col).cast("string")) - 1) if label_col else F.lit(0)
    rows = df.select(F.col(key).cast("string").alias("row_key"), idx.cast("int").alias("label_idx"),
                     counted_udf(buckets)(F.lower(F.col(text_col))).alias("c"))
    return rows.select("row_key", "label_idx", "c.bucket", "c.weight")


def validation_loss(blocks: DataFrame, kernel: LinearText, weights: np.ndarray) -> float:
    shared = blocks.sparkSession.sparkContext.broadcast((kernel, weights))

    def run(batches):
        for b in batches:
            k, w = shared.value
            for n, block in zip(b["n"].to_pylist(), passes.unpacked(b)):
                total = sum(k.gradient(w, block, rows)[0] * len(rows) for rows in np.array_split(np.arange(n), max(1, n // 256)))
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([float(total)])], names=["n", "loss"])

    with passes.block_batches(blocks.sparkSession):
        r = blocks.mapInArrow(run, "n long, loss double").agg(F.sum("loss").alias("loss"), F.sum("n").alias("n")).first()
    shared.unpersist()
    return r["loss"] / r["n"] if r["n"] else 0.0


def fit_epochs(train: DataFrame, val: DataFrame, key: str, state_path: str, text_col: str = "text", label_col: str = "label",
               epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE, warm_up: int = WARM_UP, decay: float = DECAY,
               patience: int = 2, buckets: int = BUCKETS, seed: int = 42, stop_after: int | None = None) -> EpochModel:
    """The best epoch's model.  ``state_path`` is a folder of the run's own in shared
    storage; ``stop_after`` ends this call after so many epochs of its own."""
    spark = train.sparkSession
    labels = sorted(str(r[0]) for r in train.select(label_col).where(F.col(label_col).isNotNull()).distinct().collect())
    kernel = LinearText(buckets, len(labels), rate)

    def blocks(df: DataFrame):
        rows = hashed(df.where(F.col(label_col).cast("string").isin(*labels)), key, text_col, label_col, labels, buckets)
        rows = cut_lineage(rows, "hashed")
        wide = rows.agg(F.avg(F.size("bucket"))).first()[0] or 0
        return (*passes.packed(rows, "row_key", ["bucket", "weight", "label_idx"], int(12 * wide) + 8), rows.count())

    b, shards, n = blocks(train)
    vb, _, _ = blocks(val)
    per_epoch = max(1, -(-n // (batch * shards)))
    adam = Adam(decay=decay, batch=batch, schedule=Schedule(min(warm_up, per_epoch * epochs // 2), per_epoch * epochs))
    saved = passes.last_state(spark, state_path)
    if saved:
        state, val_losses, best_epoch, best = saved[1]
    else:
        state, val_losses, best_epoch, best = passes.fresh(kernel), [], 0, None
    own = 0
    while state.epoch < epochs and len(val_losses) - best_epoch < patience and (stop_after is None or own < stop_after):
        passes.one_pass(b, shards, [kernel], [state], 1, adam, seed)
        val_losses = [*val_losses, validation_loss(vb, kernel, state.p)]
        if best is None or val_losses[-1] < min(val_losses[:-1]):
            best_epoch, best = state.epoch, state.p
        passes.save_state(spark, state_path, state.epoch, (state, val_losses, best_epoch, best))
        own += 1
    return EpochModel(labels, kernel, best if best is not None else state.p, best_epoch, state.losses, val_losses)


def score_epochs(model: EpochModel, df: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """(key as text, probabilities, prediction) of every row."""
    shared = df.sparkSession.sparkContext.broadcast((model.kernel, model.weights))

    @F.pandas_udf("array<double>")
    def score(at: pd.Series, weight: pd.Series) -> pd.Series:
        k, w = shared.value
        size = at.map(len).to_numpy()
        flat = [np.concatenate([np.zeros(0), *x.to_list()]) for x in (at, weight)]
        return pd.Series(list(k.scores(w, np.repeat(np.arange(len(at)), size), flat[0].astype(int), flat[1], len(at))))

    rows = hashed(df, key, text_col, None, [""], model.kernel.buckets)
    out = rows.select("row_key", score("bucket", "weight").alias("probabilities"))
    lab = F.array(*[F.lit(x) for x in model.labels])
    return out.withColumn("prediction", F.element_at(lab, F.array_position("probabilities", F.array_max("probabilities")).cast("int")))
