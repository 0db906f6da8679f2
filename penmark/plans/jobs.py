"""End-to-end jobs: train, predict, profile.

Each job is one lazy plan per phase with few actions: the split labels
rows where they are read (no copy of the text is written), bounds and class
lists are one-row / class-sized actions, the narrow stage-2 feature table is
written once to the shared folder (reliable, survives executor loss), then
the two fits, one aggregation for the evaluation and the save.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penmark.functions.features import ENGINEERED_FEATURES, add_text_column
from penmark.operators import metrics as M
from penmark.operators import models as ML
from penmark.operators import profile as P
from penmark.operators.dataset import stratified_split
from penmark.operators.featurize import feature_extraction
from penmark.session import cut_lineage
from penmark.sources.artifacts import Artifacts, load_artifacts, newest_artifacts, save_artifacts, save_version
from penmark.sources.sinks import sink_predictions


@dataclass
class TrainResult:
    artifacts: Artifacts
    stage1_val_accuracy: float
    val_accuracy: float | None
    test_predictions: DataFrame
    report: DataFrame
    confusion: DataFrame
    leaderboard: DataFrame | None = None


def with_label_index(df: DataFrame, labels: list[str], label: str = "label") -> DataFrame:
    arr = F.array(*[F.lit(x) for x in labels])
    return df.withColumn("label_idx", (F.array_position(arr, F.col(label).cast("string")) - 1).cast("double"))


def train_job(df: DataFrame, artifacts_path: str | None = None, grid_search: bool = False,
              seed: int = 42, id_col: str = "recipe_id", label: str = "label",
              grid: list[dict] | None = None, metric: str | M.Metric = "accuracy", mlp_params: dict | None = None,
              stage1_params: dict | None = None) -> TrainResult:
    """Split 64/16/20 → stage-1 text model (fit on 80 % of train, checked on the
    other 20 %) → probabilities for all rows → features with train-fitted
    bounds → SMOTE + MLP (fixed parameters or grid search on the validation
    fold) → refit on train+val → evaluation on test → artifacts."""
    base = df.where(F.col(label).isNotNull()).withColumn(label, F.col(label).cast("string"))
    base = add_text_column(base)
    # the split is a map-side labelling of the input (broadcast thresholds), so
    # re-reading the input costs what reading a copy would: no copy is written
    split = stratified_split(base, label, id_col, seed=seed)
    train = split.where(F.col("split") == "train")
    inner = stratified_split(train.drop("split"), label, id_col, test_size=0.2, val_size=0,
                             seed=seed, out="inner")
    s1 = ML.text_classifier_fit(inner.where(F.col("inner") == "train"), label_col=label, **(stage1_params or {}))
    labels = ML.model_labels(s1)
    s1_val = ML.text_classifier_score(s1, inner.where(F.col("inner") == "test"))
    pcols = ML.prob_columns(s1)
    s1_pred = F.element_at(F.array(*[F.lit(x) for x in labels]),
                           F.array_position(F.array(*[F.col(c) for c in pcols]),
                                            F.array_max(F.array(*[F.col(c) for c in pcols]))).cast("int"))
    s1_acc = M.accuracy(s1_val.withColumn("prediction", s1_pred), label).first()["accuracy"]

    scored = ML.text_classifier_score(s1, split)
    feats, bounds = feature_extraction(scored, "split")
    feature_cols = ENGINEERED_FEATURES + pcols
    feats = cut_lineage(with_label_index(feats, labels, label)
                        .select(id_col, F.col(label).alias("label"), "label_idx", "split", *feature_cols))
    board = None
    if grid_search:
        model, board = ML.grid_search(feats, feature_cols, labels, id_col, grid=grid, metric=metric)
        name = metric if isinstance(metric, str) else metric.name
        val_acc = board.orderBy(F.desc(f"val_{name}")).first()["val_accuracy"]
    else:
        model, val_acc = ML.train_val_score(feats, feature_cols, labels, id_col, **(mlp_params or {}))
    test = ML.mlp_predict(model, feats.where(F.col("split") == "test"), feature_cols, labels)
    kind = df.schema[label].dataType.simpleString()
    art = Artifacts(s1, model, bounds, feature_cols, labels, kind)
    if artifacts_path:
        save_artifacts(df.sparkSession, art, artifacts_path)
    return TrainResult(art, s1_acc, val_acc, test, M.classification_report(test),
                       M.confusion_matrix(test, labels), board)


def train_or_load(df: DataFrame, root: str, reuse: bool = True, **kw) -> Artifacts:
    """The newest artifacts under ``root``; trained and saved there as a new
    version if there are none or ``reuse`` is off."""
    spark = df.sparkSession
    path = newest_artifacts(spark, root) if reuse else None
    if path is None:
        path = save_version(spark, train_job(df, **kw).artifacts, root)
    return load_artifacts(spark, path)


def predict_job(df: DataFrame, artifacts: Artifacts | str, id_col: str = "recipe_id",
                output_path: str | None = None, text_path: str | None = None) -> DataFrame:
    """Score new rows with stored artifacts: text → stage-1 probabilities →
    features with the stored bounds (ingredient count recomputed from the
    list, as the reference's predict path does) → stage-2 label."""
    spark = df.sparkSession
    art = load_artifacts(spark, artifacts) if isinstance(artifacts, str) else artifacts
    t = add_text_column(df)
    scored = ML.text_classifier_score(art.stage1, t)
    feats, _ = feature_extraction(scored, split_col="", bounds=art.bounds, recount_ingredients=True)
    pred = ML.mlp_predict(art.stage2, feats, art.feature_cols, art.labels) \
        .select(id_col, F.col("prediction").cast(art.label_type).alias("prediction"))
    if output_path:
        return sink_predictions(pred, output_path, id_col, "prediction", text_path)
    return pred


def profile_job(df: DataFrame, label: str = "label", approx: bool = False) -> dict[str, DataFrame]:
    """Class counts, the classes in display order, per-class box statistics of the
    five features (``box_all``: with a zero row for a class without values), and
    the description-length clip limit: the tables behind the charts."""
    f = P.profile_features(df, label)
    order, box = P.numeric_first_order(f), P.group_box_stats(f, approx=approx)
    return {"counts": P.class_counts(f), "order": order, "box": box,
            "box_all": P.empty_group_zero(box, order, P.BOX_FEATURES),
            "clip_limit": P.global_quantile(f, "len_description", approx=approx)}
