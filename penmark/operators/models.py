"""Two-stage classifier.

Stage 1 learns the label from the combined text (naive Bayes by grouped sums, or
hashed TF-IDF + Spark's logistic regression — the distributed stand-ins for a
fine-tuned transformer) and turns each row into K class probabilities.  Stage 2
is a network over those probabilities plus the engineered features, trained on
SMOTE-balanced rows.  Model selection uses a predefined validation fold; all
combinations of the grid train in the same passes over the rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer, StringIndexer, VectorAssembler
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from penmark.functions.features import explode_probabilities
from penmark.operators import textmodel
from penmark.operators.metrics import Accuracy, MacroF1, Metric, measure
from penmark.operators.network import Network, fit_networks, prediction_udf
from penmark.operators.smote import smote_oversample
from penmark.operators.textmodel import TextModel
from penmark.session import cut_lineage

PROB_PREFIX = "prob_"

# The reference's stage-2 network (one hidden layer of 128, ReLU,
# L2 1e-3, step 1e-3, at most 1000 iterations, seed 42) and its grid.
HIDDEN = (128,)
ACTIVATION = "relu"
ALPHA = 1e-3
RATE = 1e-3
MAX_ITER = 1000
SEED = 42
GRID_HIDDEN = [(64,), (128,), (256,), (64, 32), (128, 64), (256, 128)]
GRID_ALPHA = [1e-3, 1e-4, 1e-5]
GRID_RATE = [0.01, 0.001]
GRID_ACTIVATION = ["relu", "tanh"]


# ---------------------------------------------------------------- stage 1

# Stage-1 defaults.  Naive Bayes over hashed term counts is one aggregation
# pass, where logistic regression passes over the data about 60 times.
TEXT_MODEL = "bayes"
TEXT_REG = 0.01
LR_FEATURES = 1 << 15


def logistic_fit(train: DataFrame, text_col: str, label_col: str, num_features: int = LR_FEATURES,
                 max_iter: int = 100, reg: float = TEXT_REG) -> PipelineModel:
    """Label indexer, tokens, hashed TF-IDF, multinomial logistic regression.

    The hashed term counts (sparse, about the size of the text) are kept for the
    IDF pass and the optimiser's passes instead of tokenising anew; a lost block
    is recomputed from the deterministic plan."""
    indexer = StringIndexer(inputCol=label_col, outputCol="label_idx", stringOrderType="alphabetAsc",
                            handleInvalid="error").fit(train.select(label_col))
    tok = RegexTokenizer(inputCol=text_col, outputCol="_tokens", pattern=textmodel.WORD_SPLIT, toLowercase=True, minTokenLength=1)
    tf = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features)
    counts = tf.transform(tok.transform(indexer.transform(train.select(text_col, label_col)))).select("label_idx", "_tf")
    counts = counts.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        idf = IDF(inputCol="_tf", outputCol="_tfidf").fit(counts)
        lr = LogisticRegression(featuresCol="_tfidf", labelCol="label_idx", family="multinomial", maxIter=max_iter, regParam=reg,
                                probabilityCol="_prob", predictionCol="_pred", rawPredictionCol="_raw").fit(idf.transform(counts))
    finally:
        counts.unpersist()
    return PipelineModel(stages=[indexer, tok, tf, idf, lr])


def text_classifier_fit(train: DataFrame, text_col: str = "text", label_col: str = "label",
                        model: str = TEXT_MODEL, **kw) -> TextModel | PipelineModel:
    """Fit stage 1: ``model='bayes'`` (one pass of grouped sums) or ``'logistic'``."""
    if model == "bayes":
        return textmodel.fit(train, text_col, label_col, **kw)
    if model == "logistic":
        return logistic_fit(train, text_col, label_col, **kw)
    raise ValueError(f"unknown text model {model!r}")


def model_labels(model: TextModel | PipelineModel) -> list[str]:
    """Class list in index order."""
    return list(model.labels if isinstance(model, TextModel) else model.stages[0].labelsArray[0])


def text_classifier_score(model: TextModel | PipelineModel, df: DataFrame, keep: Sequence[str] | None = None,
                          prefix: str = PROB_PREFIX, text_col: str = "text", fold_col: str | None = None) -> DataFrame:
    """Add one probability column per class (index order) to ``df``."""
    if isinstance(model, TextModel):
        scored = textmodel.score(model, df, text_col, "_prob", fold_col)
    else:   # the label indexer is a fitting-time stage only: scoring needs no label
        scored = PipelineModel(model.stages[1:]).transform(df).withColumn("_prob", vector_to_array("_prob"))
    cols = list(keep) if keep is not None else list(df.columns)
    # one evaluation of the model a row: the array is computed below the columns taken from it
    scored = scored.select(*cols, "_prob")
    return scored.select(*cols, *explode_probabilities(F.col("_prob"), model_labels(model), prefix))


def prob_columns(model: PipelineModel, prefix: str = PROB_PREFIX) -> list[str]:
    return [f"{prefix}{lab}" for lab in model_labels(model)]


# ---------------------------------------------------------------- stage 2

def balanced_training_rows(df: DataFrame, feature_cols: Sequence[str], id_col: str,
                           label_col: str = "label_idx", k: int = 5, seed: int = SEED) -> DataFrame:
    """(row_key, label_idx, features array) with SMOTE rows added inside every class."""
    vec = training_rows(df, feature_cols, id_col, label_col)
    bal = smote_oversample(vec, "row_key", "label_idx", "features", k=k, seed=seed)
    return bal.select("row_key", F.col("label").cast("double").alias("label_idx"), F.col("vec").alias("features"))


def training_rows(df: DataFrame, feature_cols: Sequence[str], id_col: str, label_col: str = "label_idx") -> DataFrame:
    return require_features(df, feature_cols).select(F.col(id_col).alias("row_key"), F.col(label_col).alias("label_idx"),
                                                     F.array(*[F.col(c) for c in feature_cols]).alias("features"))


def require_features(df: DataFrame, feature_cols: Sequence[str]) -> DataFrame:
    """``df`` whose evaluation fails, with the column's name, where a feature is
    missing or NaN: neither model can use such a row."""
    def checked(c: str) -> Column:
        x = F.col(c).cast("double")
        bad = x.isNull() | F.isnan(x)
        return F.when(bad, F.raise_error(F.lit(f"feature {c} is missing")).cast("double")).otherwise(x)
    return df.withColumns({c: checked(c) for c in feature_cols})


def assemble(df: DataFrame, feature_cols: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(feature_cols), outputCol="features",
                           handleInvalid="error").transform(require_features(df, feature_cols))


def combination(hidden: Sequence[int] = HIDDEN, activation: str = ACTIVATION, alpha: float = ALPHA, rate: float = RATE,
                max_iter: int = MAX_ITER, seed: int = SEED) -> dict:
    return {"hidden": tuple(hidden), "activation": activation, "alpha": alpha, "rate": rate, "max_iter": max_iter, "seed": seed}


def mlp_fit(train: DataFrame, feature_cols: Sequence[str], n_classes: int, id_col: str, smote: bool = True, **params) -> Network:
    """One network of the given parameters (see ``combination``)."""
    rows = (balanced_training_rows if smote else training_rows)(train, feature_cols, id_col)
    return fit_networks(rows, len(feature_cols), n_classes, [combination(**params)])[0]


def features_array(df: DataFrame, feature_cols: Sequence[str]) -> DataFrame:
    """``df`` with the checked features as an array ``_features``."""
    return require_features(df, feature_cols).withColumn("_features", F.array(*[F.col(c) for c in feature_cols]))


def mlp_predict(model: Network, df: DataFrame, feature_cols: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """Add ``prediction_idx`` and the decoded ``prediction`` label."""
    rows = features_array(df, feature_cols)
    found = prediction_udf(df, [model])(F.col("_features"))
    out = rows.withColumn("prediction_idx", found[0].cast("double")).drop("_features")
    lab = F.array(*[F.lit(x) for x in labels])
    return out.withColumn("prediction", F.element_at(lab, F.col("prediction_idx").cast("int") + 1))


def train_val_score(df: DataFrame, feature_cols: Sequence[str], labels: Sequence[str],
                    id_col: str, split_col: str = "split", **params) -> tuple[Network, float]:
    """Fit on train, score validation, then refit on train + validation."""
    train = df.where(F.col(split_col) == "train")
    val = df.where(F.col(split_col) == "val")
    m = mlp_fit(train, feature_cols, len(labels), id_col, **params)
    # written first: a task that predicts and counts would hold two workers
    found = cut_lineage(mlp_predict(m, val, feature_cols, labels).select("label", "prediction"), "validation")
    val_acc = measure(found, Accuracy()).first()["value"]
    final = mlp_fit(df.where(F.col(split_col).isin("train", "val")), feature_cols, len(labels), id_col, **params)
    return final, val_acc


def param_grid(hidden: Sequence[Sequence[int]] = GRID_HIDDEN, alphas: Sequence[float] = GRID_ALPHA,
               rates: Sequence[float] = GRID_RATE, activations: Sequence[str] = GRID_ACTIVATION,
               max_iter: int = MAX_ITER, seed: int = SEED) -> list[dict]:
    return [combination(h, act, a, r, max_iter, seed) for h, a, r, act in itertools.product(hidden, alphas, rates, activations)]


def grid_search(df: DataFrame, feature_cols: Sequence[str], labels: Sequence[str], id_col: str,
                grid: Sequence[dict] | None = None, split_col: str = "split",
                metric: str | Metric = "accuracy") -> tuple[Network, DataFrame]:
    """Fit every combination on train (-1 fold), score on validation (0 fold),
    refit the best by ``metric`` (accuracy, f1: the classes' mean F1, or a
    ``Metric``; of equal ones the first) on train + validation.  Returns (network,
    leaderboard frame).

    All combinations train in the same passes, and are scored in one."""
    spark = df.sparkSession
    grid = [combination(**g) for g in grid] if grid else param_grid()
    k = len(labels)
    rows = balanced_training_rows(df.where(F.col(split_col) == "train"), feature_cols, id_col)
    nets = fit_networks(rows, len(feature_cols), k, grid)
    val = features_array(df.where(F.col(split_col) == "val"), feature_cols)
    lab = F.array(*[F.lit(x) for x in labels])
    each = val.select("label", prediction_udf(df, nets)(F.col("_features")).alias("found"))
    each = cut_lineage(each, "validation").select("label", F.posexplode("found").alias("combo", "idx"))
    each = each.select("combo", "label", F.element_at(lab, F.col("idx") + 1).alias("prediction"))
    metrics = {"accuracy": Accuracy(), "f1": MacroF1()}
    if isinstance(metric, Metric):
        metrics[metric.name] = metric
        metric = metric.name
    found = {name: {r["combo"]: r["value"] for r in measure(each, m, by=["combo"]).collect()} for name, m in metrics.items()}
    shape = "hidden string, activation string, alpha double, rate double, max_iter int, " + ", ".join(f"val_{m} double" for m in metrics)
    board = spark.createDataFrame(
        [(str(g["hidden"]), g["activation"], g["alpha"], g["rate"], g["max_iter"], *[float(v.get(i, 0.0)) for v in found.values()])
         for i, g in enumerate(grid)], shape)
    best = grid[max(range(len(grid)), key=lambda i: (found[metric].get(i, 0.0), -i))]
    final = mlp_fit(df.where(F.col(split_col).isin("train", "val")), feature_cols, k, id_col, **best)
    return final, board


# ---------------------------------------------------------------- batch inference

def linear_predict_fn(weights: Sequence[float]):
    """``predict_batch_udf`` factory for a linear scorer (one output per row)."""
    w = np.asarray(weights, dtype=np.float64)

    def make():
        def predict(x: np.ndarray) -> np.ndarray:
            return x.astype(np.float64) @ w
        return predict
    return make


def batch_inference(df: DataFrame, vec_col: str, make_fn, dim: int, batch_size: int = 512,
                    out: str = "score") -> DataFrame:
    """Arrow-batched model call over a vector column (model built once per worker)."""
    udf = predict_batch_udf(make_fn, return_type=T.DoubleType(), batch_size=batch_size,
                            input_tensor_shapes=[[dim]])
    return df.withColumn(out, udf(F.col(vec_col).cast("array<double>")))


def out_of_fold_scores(df: DataFrame, text_col: str, label_col: str, id_col: str,
                       folds: int = 3, **kw) -> DataFrame:
    """Stage-1 probabilities for every row from a model that did not see it: fold =
    hash(id) mod folds.  One pass counts all folds; a fold's model is the total
    less the fold's counts."""
    f = df.withColumn("_fold", F.pmod(F.xxhash64(id_col), F.lit(folds)).cast("int"))
    model = textmodel.fit(f, text_col, label_col, fold_col="_fold", **kw)
    return text_classifier_score(model, f, keep=df.columns, text_col=text_col, fold_col="_fold")
