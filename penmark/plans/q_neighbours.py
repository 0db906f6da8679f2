"""Registered neighbour and balancing queries (exact kNN, SMOTE)."""

from __future__ import annotations

from pyspark.sql import functions as F

from penmark.operators.neighbours import knn_within_class
from penmark.operators.smote import smote_oversample
from penmark.plans.catalog import r6, register
from penmark.sources.fixtures import table

K = 5
SEED = 42

_E = "e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"

_KNN = f"""
pairs AS (SELECT a.vec_id AS q_id, a.label, b.vec_id AS c_id,
                 list_sum(list_transform(generate_series(1, len(a.v)),
                          lambda i: (a.v[i] - b.v[i]) * (a.v[i] - b.v[i]))) AS d2
          FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id),
knn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY d2, c_id) AS rank FROM pairs)
        WHERE rank <= {K})"""

_PLAN = f"""
ranked AS (SELECT vec_id, label,
                  row_number() OVER (PARTITION BY label
                                     ORDER BY md5(CAST(vec_id AS VARCHAR) || '-{SEED}'), vec_id) - 1 AS class_rank,
                  count(*) OVER (PARTITION BY label) AS class_n FROM e),
deficits AS (SELECT label, max(count(*)) OVER () - count(*) AS deficit FROM e GROUP BY label),
syn0 AS (SELECT r.label, r.vec_id AS base_id, r.class_n,
                unnest(range(r.class_rank, d.deficit, r.class_n)) AS s
         FROM ranked r JOIN deficits d ON r.label = d.label WHERE r.class_rank < d.deficit),
syn1 AS (SELECT *, md5(CAST(label AS VARCHAR) || '-' || CAST(s AS VARCHAR) || '-{SEED}') AS h,
                least({K}, class_n - 1) AS k_c FROM syn0),
plan AS (SELECT label, CAST(s AS BIGINT) AS s, base_id,
                CASE WHEN k_c > 0 THEN CAST(('0x' || substr(h, 1, 8)) AS BIGINT) % k_c + 1 END AS nb_rank,
                CAST(('0x' || substr(h, 9, 8)) AS BIGINT) / 4294967296.0 AS gap, k_c FROM syn1),
synth AS (SELECT p.*, coalesce(k.c_id, p.base_id) AS nb_id
          FROM plan p LEFT JOIN knn k ON k.q_id = p.base_id AND k.rank = p.nb_rank)"""


@register("knn_within_class", "WITH " + _E + "," + _KNN + """
SELECT q_id, label, CAST(rank AS BIGINT) AS rank, c_id, round(d2, 6) AS d2 FROM knn""")
def q_knn_within_class(spark, sf):
    e = table(spark, sf, "embeddings")
    nn = knn_within_class(e, "vec_id", "label", "embedding", K)
    return nn.select("q_id", "label", "rank", "c_id", r6("d2").alias("d2"))


@register("smote_plan", "WITH " + _E + "," + _KNN + "," + _PLAN + """
SELECT 'syn-' || CAST(label AS VARCHAR) || '-' || CAST(s AS VARCHAR) AS row_key, label, base_id, nb_id,
       round(CASE WHEN k_c > 0 THEN gap ELSE 0.0 END, 6) AS gap FROM synth""")
def q_smote_plan(spark, sf):
    e = table(spark, sf, "embeddings")
    out = smote_oversample(e, "vec_id", "label", "embedding", K, SEED).where("is_synthetic")
    return out.select("row_key", "label", "base_id", "nb_id", r6("gap").alias("gap"))


@register("smote_oversample", "WITH " + _E + "," + _KNN + "," + _PLAN + """,
vals AS (
  SELECT 'syn-' || CAST(s.label AS VARCHAR) || '-' || CAST(s.s AS VARCHAR) AS row_key, s.label,
         list_transform(generate_series(1, len(b.v)), lambda i: b.v[i] + s.gap * (n.v[i] - b.v[i])) AS v
  FROM synth s JOIN e b ON b.vec_id = s.base_id JOIN e n ON n.vec_id = s.nb_id
  UNION ALL SELECT CAST(vec_id AS VARCHAR), label, v FROM e)
SELECT row_key, label, CAST(i AS BIGINT) - 1 AS dim, round(v[i], 6) AS value
FROM (SELECT row_key, label, v, generate_subscripts(v, 1) AS i FROM vals)""")
def q_smote_oversample(spark, sf):
    e = table(spark, sf, "embeddings")
    out = smote_oversample(e, "vec_id", "label", "embedding", K, SEED)
    return out.select("row_key", "label", F.posexplode_outer("vec").alias("dim", "value")) \
        .select("row_key", "label", F.col("dim").cast("bigint").alias("dim"), r6("value").alias("value"))


@register("smote_class_sizes", "WITH " + _E + "," + _KNN + "," + _PLAN + """
SELECT label, CAST(count(*) AS BIGINT) AS n_rows FROM (SELECT label FROM e UNION ALL SELECT label FROM synth)
GROUP BY label""")
def q_smote_class_sizes(spark, sf):
    e = table(spark, sf, "embeddings")
    out = smote_oversample(e, "vec_id", "label", "embedding", K, SEED)
    return out.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"))

