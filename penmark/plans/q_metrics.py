"""Registered evaluation queries.

The predictions come from a fixed rule over the document text (marks typical
of each language), so the metric operators can be checked exactly against
SQL on every row of ``documents``; the trained models' predictions are
evaluated by the job queries.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from penmark.operators import dataset as D
from penmark.operators import metrics as M
from penmark.plans.catalog import r6, register
from penmark.plans.q_dataset import split_sql
from penmark.sources.fixtures import recipes_d, table, with_views

# Fixed values of the rule-based language guess (letters typical of each language).
MARKS = {"de": "äöüß", "fr": "èêçàù", "es": "ñóáí"}
LANGS = ["de", "en", "es", "fr"]


def add_guess(df, col: str = "text", out: str = "prediction"):
    """Adds the guess; counts staged as columns so each regex runs once per row."""
    cnt = {f"_m_{k}": F.length(col) - F.length(F.regexp_replace(col, f"[{v}]", "")) for k, v in MARKS.items()}
    de, fr, es = (F.col(f"_m_{k}") for k in ("de", "fr", "es"))
    g = (F.when((de > 0) & (de >= fr) & (de >= es), "de").when((fr > 0) & (fr >= es), "fr")
         .when(es > 0, "es").otherwise("en"))
    return df.withColumns(cnt).withColumn(out, g).drop(*cnt)


def _n_sql(k: str, col: str) -> str:
    return f"(length({col}) - length(regexp_replace({col}, '[{MARKS[k]}]', '', 'g')))"


def marks_sql(col: str = "text") -> str:
    de, fr, es = (_n_sql(k, col) for k in ("de", "fr", "es"))
    return (f"CASE WHEN {de} > 0 AND {de} >= {fr} AND {de} >= {es} THEN 'de' "
            f"WHEN {fr} > 0 AND {fr} >= {es} THEN 'fr' WHEN {es} > 0 THEN 'es' ELSE 'en' END")


def guessed(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("label"), "text")
    return add_guess(d).drop("text")


_PRED_SQL = f"pred AS (SELECT doc_id, lang AS label, {marks_sql()} AS prediction FROM documents)"

_REPORT_SQL = """
m_long AS (SELECT label AS actual, prediction AS predicted, count(*) AS n FROM {src}
         WHERE label IS NOT NULL GROUP BY ALL),
m_cls AS (SELECT actual AS cls FROM m_long UNION SELECT predicted FROM m_long),
m_pa AS (SELECT actual AS cls, sum(n) AS support, sum(CASE WHEN actual = predicted THEN n ELSE 0 END) AS tp
       FROM m_long GROUP BY actual),
m_pp AS (SELECT predicted AS cls, sum(n) AS n_pred FROM m_long GROUP BY predicted),
m_t AS (SELECT c.cls, coalesce(support, 0) AS support, coalesce(tp, 0) AS tp, coalesce(n_pred, 0) AS n_pred
      FROM m_cls c LEFT JOIN m_pa pa ON c.cls = pa.cls LEFT JOIN m_pp pp ON c.cls = pp.cls),
m_t2 AS (SELECT *, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS precision,
                 CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM m_t),
m_t3 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                      ELSE 0.0 END AS f1 FROM m_t2),
m_tot AS (SELECT sum(support) AS n, sum(tp) AS tp, avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf,
               sum(precision * support) AS wp, sum(recall * support) AS wr, sum(f1 * support) AS wf FROM m_t3),
m_rep AS (
  SELECT CAST(cls AS VARCHAR) AS cls, precision, recall, f1, CAST(support AS BIGINT) AS support FROM m_t3
  UNION ALL SELECT 'accuracy', NULL, NULL, CASE WHEN n > 0 THEN tp / n ELSE 0.0 END, CAST(n AS BIGINT) FROM m_tot
  UNION ALL SELECT 'macro avg', mp, mr, mf, CAST(n AS BIGINT) FROM m_tot
  UNION ALL SELECT 'weighted avg', wp / n, wr / n, wf / n, CAST(n AS BIGINT) FROM m_tot)"""


def _report_out(rep):
    return rep.select("cls", *[r6(c).alias(c) for c in ["precision", "recall", "f1"]], "support")


_REPORT_SELECT = """
SELECT cls, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM m_rep"""


@register("accuracy", "WITH " + _PRED_SQL + """
SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n
FROM pred WHERE label IS NOT NULL""")
def q_accuracy(spark, sf):
    a = M.accuracy(guessed(spark, sf))
    return a.select(r6("accuracy").alias("accuracy"), "n")


@register("confusion_matrix", "WITH " + _PRED_SQL + """,
langs AS (SELECT unnest(['de', 'en', 'es', 'fr']) AS actual)
SELECT l.actual, """ + ", ".join(
    f"CAST(count(p.doc_id) FILTER (WHERE p.prediction = '{v}') AS BIGINT) AS pred_{v}" for v in LANGS) + """
FROM langs l LEFT JOIN pred p ON p.label = l.actual GROUP BY l.actual""")
def q_confusion_matrix(spark, sf):
    return M.confusion_matrix(guessed(spark, sf), LANGS)


@register("classification_report", "WITH " + _PRED_SQL + "," + _REPORT_SQL.format(src="pred")
          + _REPORT_SELECT)
def q_classification_report(spark, sf):
    return _report_out(M.classification_report(guessed(spark, sf)))


@register("evaluate", with_views("recipes_d") + ",\n" + split_sql("recipes_d") + """,
pred AS (SELECT recipe_id, label, """ + marks_sql("description") + """ AS prediction
         FROM splitted WHERE split = 'test'),""" + _REPORT_SQL.format(src="pred") + _REPORT_SELECT)
def q_evaluate(spark, sf):
    s = add_guess(D.stratified_split(recipes_d(spark, sf)), "description")
    return _report_out(M.evaluate(s, LANGS)["report"])
