"""Registered modelling and job queries.

The text model's counts are plain SQL.  What a trained network predicts is not:
there the SQL states an invariant (the row set, predictions among the labels,
probabilities that sum to one, an accuracy above always answering the largest
class, the leaderboard's rows).
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from penmark.functions.features import ENGINEERED_FEATURES, add_text_column
from penmark.operators import models as ML
from penmark.operators import dataset as D
from penmark.operators.batched import RecordModel, labelled, score_records
from penmark.operators.epochs import fit_epochs, score_epochs
from penmark.operators.featurize import feature_extraction
from penmark.operators.metrics import Accuracy, measure
from penmark.plans import jobs as J
from penmark.plans.catalog import r6, register
from penmark.plans.q_dataset import split_sql
from penmark.plans.q_profile import _BOX_SQL
from penmark.session import cut_lineage, scratch_path
from penmark.sources.artifacts import load_artifacts, save_artifacts, save_version
from penmark.sources.fixtures import recipes_d, table, with_views

def _docs(spark, sf):
    return add_text_column(recipes_d(spark, sf, keep=True))


def _stage1(spark, sf):
    d = D.stratified_split(_docs(spark, sf))
    return d, ML.text_classifier_fit(d.where("split = 'train'"))


TEXT_SQL = """concat_ws(' ', coalesce(recipe_name, ''), coalesce(description, ''), array_to_string(ingredients, ' '),
       array_to_string(steps, ' '), array_to_string(tags, ' '))"""


def better(rows, label: str = "label", pred: str = "prediction") -> bool:
    """Whether the predictions are right more often than always answering the largest class."""
    n = rows.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.sum((F.col(label) == F.col(pred)).cast("int")).alias("hit"))
    r = n.agg(F.max("n").alias("top"), F.sum("hit").alias("hit")).first()
    return bool(r["hit"] > r["top"])


def likeliest(model):
    """The label of the largest probability column."""
    labels, pc = ML.model_labels(model), [F.col(c) for c in ML.prob_columns(model)]
    return F.element_at(F.array(*[F.lit(x) for x in labels]), F.array_position(F.array(*pc), F.array_max(F.array(*pc))).cast("int"))


@register("text_classifier_fit", with_views("recipes_d") + ",\n" + split_sql("recipes_d") + """,
train AS (SELECT label, lower(""" + TEXT_SQL + """) AS text FROM splitted WHERE split = 'train'),
toks AS (SELECT label, unnest(regexp_extract_all(text, '[\\p{L}\\p{N}]+')) AS token FROM train)
SELECT label, CAST(('0x' || md5(token)[1:8])::BIGINT % 262144 AS INTEGER) AS bucket, count(*) AS n, true AS better FROM toks GROUP BY 1, 2
UNION ALL SELECT label, -1, count(*), true FROM train GROUP BY 1""")
def q_text_classifier_fit(spark, sf):
    """The counts that are the model; ``better``: on the validation rows it beats the largest class."""
    d, m = _stage1(spark, sf)
    s = ML.text_classifier_score(m, d.where("split = 'val'"), keep=["label"]).select("label", likeliest(m).alias("prediction"))
    return m.counts.select("label", "bucket", "n", F.lit(better(s)).alias("better"))


@register("text_classifier_score", """
SELECT doc_id AS recipe_id, 1.0 AS prob_sum FROM documents""")
def q_text_classifier_score(spark, sf):
    d, m = _stage1(spark, sf)
    s = ML.text_classifier_score(m, d, keep=["recipe_id"])
    total = sum((F.col(c) for c in ML.prob_columns(m)), F.lit(0.0))
    return s.select("recipe_id", r6(total).alias("prob_sum"))


@register("stack_features", with_views("recipes_d") + ",\n" + split_sql("recipes_d") + f"""
SELECT recipe_id, split,
       CAST({len(ENGINEERED_FEATURES)} + (SELECT count(DISTINCT label) FROM splitted WHERE split = 'train')
            AS INTEGER) AS n_features
FROM splitted""")
def q_stack_features(spark, sf):
    d, m = _stage1(spark, sf)
    f, _ = feature_extraction(ML.text_classifier_score(m, d), "split")
    cols = ENGINEERED_FEATURES + ML.prob_columns(m)
    a = ML.assemble(f, cols)
    return a.select("recipe_id", "split", F.size(vector_to_array("features")).alias("n_features"))


def _stage2_input(spark, sf):
    d, m = _stage1(spark, sf)
    f, _ = feature_extraction(ML.text_classifier_score(m, d), "split")
    labels = ML.model_labels(m)
    cols = ENGINEERED_FEATURES + ML.prob_columns(m)
    f = J.with_label_index(f, labels).select("recipe_id", "label", "label_idx", "split", *cols)
    return cut_lineage(f), cols, labels


@register("mlp_fit", with_views("recipes_d") + ",\n" + split_sql("recipes_d") + """
SELECT recipe_id, label, true AS known, true AS better FROM splitted WHERE split = 'val'""")
def q_mlp_fit(spark, sf):
    f, cols, labels = _stage2_input(spark, sf)
    model = ML.mlp_fit(f.where("split = 'train'"), cols, len(labels), "recipe_id")
    p = cut_lineage(ML.mlp_predict(model, f.where("split = 'val'"), cols, labels).select("recipe_id", "label", "prediction"))
    return p.select("recipe_id", "label", F.col("prediction").isin(*labels).alias("known"), F.lit(better(p)).alias("better"))


@register("mlp_predict", with_views("recipes_d") + ",\n" + split_sql("recipes_d") + """
SELECT recipe_id, true AS known FROM splitted WHERE split = 'test'""")
def q_mlp_predict(spark, sf):
    f, cols, labels = _stage2_input(spark, sf)
    model = ML.mlp_fit(f.where("split = 'train'"), cols, len(labels), "recipe_id")
    p = ML.mlp_predict(model, f.where("split = 'test'"), cols, labels)
    return p.select("recipe_id", F.col("prediction").isin(*labels).alias("known"))


@register("train_val_score", """
SELECT count(DISTINCT lang) AS n_classes, true AS better, true AS valid FROM documents""")
def q_train_val_score(spark, sf):
    f, cols, labels = _stage2_input(spark, sf)
    net, acc = ML.train_val_score(f, cols, labels, "recipe_id")
    val = f.where("split = 'val'").groupBy("label").count().agg((F.max("count") / F.sum("count")).alias("top")).first()["top"]
    return spark.range(1).select(F.lit(net.sizes[-1]).cast("bigint").alias("n_classes"), F.lit(bool(acc > val)).alias("better"),
                                 F.lit(bool(0 <= acc <= 1)).alias("valid"))


@register("grid_search", "SELECT * FROM (VALUES " + ", ".join(
    f"('{g['hidden']}', '{g['activation']}', {g['alpha']}::DOUBLE, {g['rate']}::DOUBLE, {g['max_iter']}, true, true)" for g in ML.param_grid())
    + ") g(hidden, activation, alpha, rate, max_iter, valid, refitted)")
def q_grid_search(spark, sf):
    """The whole grid's leaderboard; ``valid``: scores are shares; ``refitted``: the
    returned network has the best row's shape and beats the largest class."""
    f, cols, labels = _stage2_input(spark, sf)
    net, board = ML.grid_search(f, cols, labels, "recipe_id")
    top = board.agg(F.max("val_accuracy")).first()[0]
    shapes = {r["hidden"] for r in board.where(F.col("val_accuracy") == top).collect()}
    val = f.where("split = 'val'")
    refitted = str(tuple(net.sizes[1:-1])) in shapes and better(ML.mlp_predict(net, val, cols, labels))
    return board.select("hidden", "activation", "alpha", "rate", "max_iter",
                        (F.col("val_accuracy").between(0, 1) & F.col("val_f1").between(0, 1)).alias("valid"), F.lit(refitted).alias("refitted"))


@register("out_of_fold_scores", """
SELECT doc_id AS recipe_id, lang AS label, 1.0 AS prob_sum, true AS better FROM documents""")
def q_out_of_fold_scores(spark, sf):
    d = _docs(spark, sf)
    s = ML.out_of_fold_scores(d, "text", "label", "recipe_id", folds=3)
    pc = [c for c in s.columns if c.startswith(ML.PROB_PREFIX)]
    s = cut_lineage(s.select("recipe_id", "label", *pc))
    best = F.element_at(F.array(*[F.lit(c.removeprefix(ML.PROB_PREFIX)) for c in pc]),
                        F.array_position(F.array(*pc), F.array_max(F.array(*pc))).cast("int"))
    good = better(s.withColumn("prediction", best))
    return s.select("recipe_id", "label", r6(sum((F.col(c) for c in pc), F.lit(0.0))).alias("prob_sum"), F.lit(good).alias("better"))


@register("train_job", with_views("recipes_d") + ",\n" + split_sql("recipes_d") + """,
t AS (SELECT label, count(*) AS support FROM splitted WHERE split = 'test' GROUP BY label),
n AS (SELECT sum(support) AS support FROM t)
SELECT label AS cls, CAST(support AS BIGINT) AS support, true AS consistent FROM t
UNION ALL SELECT unnest(['accuracy', 'macro avg', 'weighted avg']), CAST(support AS BIGINT), true FROM n""")
def q_train_job(spark, sf):
    """Supports of the test split; ``consistent``: the report's recalls, weighted by
    support, give its accuracy, which beats always answering the largest class."""
    rep = J.train_job(recipes_d(spark, sf, keep=True)).report
    own = ~F.col("cls").isin("accuracy", "macro avg", "weighted avg")
    one = rep.agg(F.max(F.when(F.col("cls") == "accuracy", F.col("f1"))).alias("acc"),
                  F.sum(F.when(own, F.col("recall") * F.col("support"))).alias("hits"),
                  F.max(F.when(own, F.col("support"))).alias("top"), F.sum(F.when(own, F.col("support"))).alias("n")).first()
    ok = abs(one["hits"] / one["n"] - one["acc"]) < 1e-9 and one["acc"] > one["top"] / one["n"]
    return rep.select("cls", "support", F.lit(bool(ok)).alias("consistent"))


@register("predict_job", """
SELECT doc_id AS recipe_id, true AS known FROM documents""")
def q_predict_job(spark, sf):
    d = recipes_d(spark, sf, keep=True)
    path = scratch_path(spark, "artifacts")
    labels = J.train_job(d, artifacts_path=path).artifacts.labels
    return J.predict_job(d.drop("label"), path).select("recipe_id", F.col("prediction").isin(*labels).alias("known"))


@register("save_artifacts", """
SELECT doc_id AS recipe_id, true AS same FROM documents""")
def q_save_artifacts(spark, sf):
    """Every row scores the same with the in-memory and the reloaded artifacts."""
    d = recipes_d(spark, sf, keep=True)
    res = J.train_job(d)
    path = save_artifacts(spark, res.artifacts, scratch_path(spark, "artifacts"))
    before = J.predict_job(d, res.artifacts).withColumnRenamed("prediction", "before")
    after = J.predict_job(d, path).withColumnRenamed("prediction", "after")
    return before.join(after, "recipe_id", "full").select(
        "recipe_id", F.coalesce(F.col("before") == F.col("after"), F.lit(False)).alias("same"))


@register("load_artifacts", """
SELECT feature, CAST(position AS INTEGER) AS position FROM (
  SELECT * FROM (VALUES """ + ", ".join(f"('{c}', {i})" for i, c in enumerate(ENGINEERED_FEATURES)) + """) f(feature, position)
  UNION ALL
  SELECT 'prob_' || lang, """ + str(len(ENGINEERED_FEATURES)) + """ + row_number() OVER (ORDER BY lang) - 1
  FROM (SELECT DISTINCT lang FROM documents))""")
def q_load_artifacts(spark, sf):
    d = recipes_d(spark, sf, keep=True)
    res = J.train_job(d)
    path = save_artifacts(spark, res.artifacts, scratch_path(spark, "artifacts"))
    art = load_artifacts(spark, path)
    return spark.createDataFrame([(c, i) for i, c in enumerate(art.feature_cols)], "feature string, position int")


@register("batch_inference", """
SELECT vec_id, round(list_sum(list_transform(generate_series(1, len(embedding)),
       lambda i: CAST(embedding[i] AS DOUBLE) / i)), 6) AS score FROM embeddings""")
def q_batch_inference(spark, sf):
    e = table(spark, sf, "embeddings")
    dim = len(e.select("embedding").first()[0])   # vector width from one row
    w = [1.0 / (i + 1) for i in range(dim)]
    s = ML.batch_inference(e, "embedding", ML.linear_predict_fn(w), dim)
    return s.select("vec_id", r6("score").alias("score"))


@register("profile_job", _BOX_SQL)
def q_profile_job(spark, sf):
    out = J.profile_job(recipes_d(spark, sf))["box"]
    return out.select("feature", "label", "n", *[r6(c).alias(c) for c in
                      ["q1", "median", "q3", "min_value", "max_value", "whisker_lo", "whisker_hi"]],
                      "n_outliers")


@register("stream_score", """
SELECT doc_id AS recipe_id, true AS known FROM documents""")
def q_stream_score(spark, sf):
    """Train on the documents, then score them again through a streaming query
    (Parquet source written from the table, availableNow trigger)."""
    from penmark.streaming.score import start_stream_score
    d = recipes_d(spark, sf, keep=True)
    res = J.train_job(d)
    src = scratch_path(spark, "stream-in")
    d.drop("label").write.mode("overwrite").parquet(src)
    out = scratch_path(spark, "stream-out")
    q = start_stream_score(spark, src, d.drop("label").schema, res.artifacts, out)
    q.awaitTermination()
    return spark.read.parquet(out).select("recipe_id", F.col("prediction").isin(*res.artifacts.labels).alias("known"))


@register("text_epochs_fit", """
SELECT doc_id AS recipe_id, true AS known, true AS better, true AS best_kept FROM documents""")
def q_text_epochs_fit(spark, sf):
    """Epoch training on the documents, all rows scored by the best epoch; ``best_kept``:
    no other epoch's validation loss is smaller."""
    d = D.stratified_split(_docs(spark, sf)).select("recipe_id", "label", "text", "split")
    m = fit_epochs(d.where("split = 'train'"), d.where("split = 'val'"), "recipe_id", scratch_path(spark, "epochs"))
    kept = m.val_losses[m.best_epoch - 1] == min(m.val_losses)
    s = cut_lineage(score_epochs(m, d, "recipe_id").withColumn("recipe_id", F.col("row_key").cast("bigint")))
    good = better(s.join(d.where("split = 'test'").select("recipe_id", "label"), "recipe_id"))
    return s.select("recipe_id", F.col("prediction").isin(*m.labels).alias("known"), F.lit(good).alias("better"), F.lit(kept).alias("best_kept"))


class TokenShares:
    """Fixed scorer for the query: shares of a text's tokens by length modulo 3,
    one added to each."""

    @staticmethod
    def load():
        return None

    @staticmethod
    def encode(_, text):
        return [len(w) % 3 for w in text.split(" ") if w]

    @staticmethod
    def predict(_, ids, mask):
        n = np.stack([((ids == c) & mask).sum(1) + 1.0 for c in range(3)], 1)
        return n / n.sum(1, keepdims=True)


@register("batch_records", """
WITH w AS (SELECT doc_id, list_filter(string_split(coalesce(text, ''), ' '), lambda x: x <> '') ws FROM documents),
n AS (SELECT doc_id, [1 + len(list_filter(ws, lambda x: length(x) % 3 = 0)), 1 + len(list_filter(ws, lambda x: length(x) % 3 = 1)),
                      1 + len(list_filter(ws, lambda x: length(x) % 3 = 2))] c, len(ws) + 3 t FROM w)
SELECT doc_id, round(c[1] / t, 6) AS p0, round(c[2] / t, 6) AS p1, round(c[3] / t, 6) AS p2,
       CASE WHEN c[1] >= c[2] AND c[1] >= c[3] THEN 'zero' WHEN c[2] >= c[3] THEN 'one' ELSE 'two' END AS prediction FROM n""")
def q_batch_records(spark, sf):
    """Token-bounded, length-bucketed batches through a caller's model."""
    model = RecordModel(TokenShares.load, TokenShares.encode, TokenShares.predict)
    d = table(spark, sf, "documents").select("doc_id", "text")
    s = labelled(score_records(d, "text", model), ["zero", "one", "two"])
    return s.select("doc_id", *[r6(F.col("probabilities")[i]).alias(f"p{i}") for i in range(3)], "prediction")


@register("user_metric", with_views("recipes_d") + ",\n" + split_sql("recipes_d") + """
SELECT split, round(avg(CAST(label = 'en' AS DOUBLE)), 6) AS accuracy FROM splitted GROUP BY split""")
def q_user_metric(spark, sf):
    """A metric written as a mergeable aggregate, by split: always answering ``en``."""
    d = D.stratified_split(recipes_d(spark, sf)).select("split", "label").withColumn("prediction", F.lit("en"))
    return measure(d, Accuracy(), by=["split"]).select("split", r6("value").alias("accuracy"))


@register("stream_score_keyed", """
SELECT doc_id AS recipe_id, true AS known, 1 AS n FROM documents""")
def q_stream_score_keyed(spark, sf):
    """A stream scored batch by batch with the newest artifacts; one batch is run
    again and leaves the output unchanged."""
    from penmark.streaming.score import KeyedScorer, start_keyed_score
    d = recipes_d(spark, sf, keep=True)
    root, src, out = (scratch_path(spark, x) for x in ("stream-models", "stream-in", "stream-out"))
    res = J.train_job(d)
    save_version(spark, res.artifacts, root)
    d.drop("label").write.mode("overwrite").parquet(src)
    start_keyed_score(spark, src, d.drop("label").schema, root, out, scratch_path(spark, "stream-ckpt")).awaitTermination()
    KeyedScorer(root, out)(spark.read.parquet(src), 0)
    got = spark.read.parquet(out).groupBy("recipe_id").agg(F.count(F.lit(1)).cast("int").alias("n"), F.max("prediction").alias("prediction"))
    return got.select("recipe_id", F.col("prediction").isin(*res.artifacts.labels).alias("known"), "n")
