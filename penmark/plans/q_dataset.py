"""Registered dataset-preparation queries (split, rank, encode, folds)."""

from __future__ import annotations

from pyspark.sql import functions as F

from penmark.operators import dataset as D
from penmark.operators.joins import map_lookup
from penmark.plans.catalog import register
from penmark.sources.fixtures import recipes_d, recipes_o, table, with_views


def rank_sql(src: str, seed: int = 42) -> str:
    return f"""ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY label
                 ORDER BY md5(CAST(recipe_id AS VARCHAR) || '-{seed}'), recipe_id) - 1 AS BIGINT) AS class_rank,
         CAST(count(*) OVER (PARTITION BY label) AS BIGINT) AS class_n
  FROM {src})"""


def alloc_sql(prev: str, name: str, n_col: str, frac: float, keep: str) -> str:
    """DuckDB text of the per-class allocation (same arithmetic as the Spark side)."""
    return f"""{name}_a AS (
  SELECT *, sum({n_col}) OVER () AS _n FROM {prev}),
{name}_b AS (
  SELECT *, CAST(ceil(CAST(_n AS DOUBLE) * {float(frac)!r}) AS BIGINT) AS _nout FROM {name}_a),
{name}_c AS (
  SELECT *, _n - _nout AS _nkeep, ({n_col} * (_n - _nout)) // _n AS _base,
            ({n_col} * (_n - _nout)) % _n AS _rem FROM {name}_b),
{name}_d AS (
  SELECT *, (_nkeep - sum(_base) OVER ()) AS _need,
            row_number() OVER (ORDER BY _rem DESC, label) AS _pos FROM {name}_c),
{name} AS (
  SELECT * EXCLUDE (_n, _nout, _nkeep, _base, _rem, _need, _pos),
         CAST(_base + CASE WHEN _pos <= _need THEN 1 ELSE 0 END AS BIGINT) AS {keep} FROM {name}_d)"""


def split_sql(src: str, test: float = 0.2, val: float = 0.2) -> str:
    """CTEs ending in ``splitted`` (src columns + split) for a source view."""
    parts = [rank_sql(src),
             "cls AS (SELECT label, CAST(count(*) AS BIGINT) AS class_n FROM " + src + " GROUP BY label)",
             alloc_sql("cls", "al1", "class_n", test, "keep1")]
    if val > 0:
        parts.append(alloc_sql("al1", "al2", "keep1", val, "n_train"))
        parts.append("sizes AS (SELECT label, class_n - keep1 AS n_test, keep1 - n_train AS n_val FROM al2)")
    else:
        parts.append("sizes AS (SELECT label, class_n - keep1 AS n_test, 0 AS n_val FROM al1)")
    parts.append("""splitted AS (
  SELECT r.* EXCLUDE (class_rank, class_n),
         CASE WHEN class_rank < n_test THEN 'test'
              WHEN class_rank < n_test + n_val THEN 'val' ELSE 'train' END AS split
  FROM ranked r JOIN sizes s ON r.label IS NOT DISTINCT FROM s.label)""")
    return ",\n".join(parts)


@register("stratified_rank", with_views("recipes_d") + ",\n" + rank_sql("recipes_d") + """
SELECT recipe_id, label, class_rank, class_n FROM ranked""")
def q_stratified_rank(spark, sf):
    return D.stratified_rank(recipes_d(spark, sf)).select("recipe_id", "label", "class_rank", "class_n")


@register("stratified_split", with_views("recipes_d") + ",\n" + split_sql("recipes_d") + """
SELECT recipe_id, label, split FROM splitted""")
def q_stratified_split(spark, sf):
    return D.stratified_split(recipes_d(spark, sf)).select("recipe_id", "label", "split")


@register("stratified_split_2way", with_views("recipes_o") + ",\n" + split_sql("recipes_o", 0.2, 0) + """
SELECT recipe_id, label, split FROM splitted""")
def q_stratified_split_2way(spark, sf):
    return D.stratified_split(recipes_o(spark, sf), val_size=0).select("recipe_id", "label", "split")


@register("split_sizes", with_views("recipes_d") + ",\n" + split_sql("recipes_d") + """
SELECT split, count(*) AS n_rows FROM splitted GROUP BY split""")
def q_split_sizes(spark, sf):
    return D.split_sizes(D.stratified_split(recipes_d(spark, sf)))


@register("split_sizes_by_class", with_views("recipes_o") + ",\n" + split_sql("recipes_o") + """
SELECT label, split, count(*) AS n_rows FROM splitted GROUP BY label, split""")
def q_split_sizes_by_class(spark, sf):
    s = D.stratified_split(recipes_o(spark, sf))
    return s.groupBy("label", "split").agg(F.count(F.lit(1)).alias("n_rows"))


@register("union_splits", with_views("recipes_d") + ",\n" + split_sql("recipes_d") + """
SELECT recipe_id, label, split FROM splitted WHERE split = 'train'
UNION ALL SELECT recipe_id, label, split FROM splitted WHERE split = 'val'""")
def q_union_splits(spark, sf):
    s = D.stratified_split(recipes_d(spark, sf)).select("recipe_id", "label", "split")
    return s.where("split = 'train'").unionByName(s.where("split = 'val'"))


@register("union_refit_set", with_views("recipes_o") + ",\n" + split_sql("recipes_o") + """
SELECT label, count(*) AS n_rows FROM splitted WHERE split IN ('train', 'val') GROUP BY label""")
def q_union_refit_set(spark, sf):
    s = D.refit_set(D.stratified_split(recipes_o(spark, sf)))
    return s.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"))


@register("predefined_fold", with_views("recipes_d") + ",\n" + split_sql("recipes_d") + """
SELECT recipe_id, CAST(CASE split WHEN 'train' THEN -1 WHEN 'val' THEN 0 END AS BIGINT) AS fold
FROM splitted WHERE split IN ('train', 'val')""")
def q_predefined_fold(spark, sf):
    s = D.refit_set(D.stratified_split(recipes_d(spark, sf)))
    return s.select("recipe_id", D.predefined_fold().alias("fold"))


@register("label_encode", with_views("recipes_d") + """,
t AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS BIGINT) AS label_idx
      FROM (SELECT DISTINCT label FROM recipes_d WHERE label IS NOT NULL))
SELECT r.recipe_id, r.label, t.label_idx FROM recipes_d r LEFT JOIN t ON r.label = t.label""")
def q_label_encode(spark, sf):
    d = recipes_d(spark, sf)
    return D.label_encode(d, D.label_table(d)).select("recipe_id", "label", "label_idx")


@register("label_decode", with_views("recipes_o") + """,
t AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS BIGINT) AS label_idx
      FROM (SELECT DISTINCT label FROM recipes_o WHERE label IS NOT NULL))
SELECT r.recipe_id, t.label_idx, t.label AS predicted_label
FROM recipes_o r LEFT JOIN t ON r.label = t.label""")
def q_label_decode(spark, sf):
    o = recipes_o(spark, sf)
    t = D.label_table(o)
    enc = D.label_encode(o, t).select("recipe_id", "label_idx")
    return D.label_decode(enc, t, idx_col="label_idx").select("recipe_id", "label_idx", "predicted_label")


@register("first_appearance_index", """
WITH t AS (SELECT role AS label, min(conv_id * 1000000 + turn) AS first_pos
           FROM conversations WHERE role IS NOT NULL GROUP BY role)
SELECT label, CAST(row_number() OVER (ORDER BY first_pos, label) - 1 AS BIGINT) AS label_idx FROM t""")
def q_first_appearance_index(spark, sf):
    c = table(spark, sf, "conversations").select(
        F.col("role").alias("label"), (F.col("conv_id") * 1000000 + F.col("turn")).alias("pos"))
    return D.label_table(c, order="first_seen", id_col="pos")


@register("map_lookup", """
WITH t AS (SELECT lang, CAST(row_number() OVER (ORDER BY lang) - 1 AS BIGINT) AS lang_idx
           FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL))
SELECT l.doc_id, l.quality, t.lang_idx
FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id LEFT JOIN t ON d.lang = t.lang""")
def q_map_lookup(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    t = D.label_table(docs, "lang").withColumnRenamed("label_idx", "lang_idx")
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    j = lab.join(docs, "doc_id", "left")
    return map_lookup(j, t, "lang", "lang_idx").select("doc_id", "quality", "lang_idx")


@register("balance_deficits", with_views("recipes_d") + """
SELECT label, CAST(count(*) AS BIGINT) AS class_n,
       CAST(max(count(*)) OVER () - count(*) AS BIGINT) AS deficit
FROM recipes_d GROUP BY label""")
def q_balance_deficits(spark, sf):
    return D.balance_deficits(recipes_d(spark, sf))
