"""Registered profiling queries (class counts, box statistics, outliers)."""

from __future__ import annotations

from pyspark.sql import functions as F

from penmark.operators import profile as P
from penmark.plans.catalog import r6, register
from penmark.sources.fixtures import recipes_d, recipes_o, table, with_views

# DuckDB text of profile_features over a recipe view with list-derived counts.
_FEATS_D = """
f AS (SELECT recipe_id, trim(CAST(label AS VARCHAR)) AS label,
             CAST(len(ingredients) AS DOUBLE) AS n_ingredients,
             CAST(len(tags) AS DOUBLE) AS n_tags,
             CAST(len(steps) AS DOUBLE) AS n_steps,
             CAST(length(coalesce(recipe_name, '')) AS DOUBLE) AS len_recipe_name,
             CAST(length(coalesce(description, '')) AS DOUBLE) AS len_description
      FROM {src})"""

_LONG = """
long AS (UNPIVOT f ON n_ingredients, n_tags, n_steps, len_recipe_name, len_description
         INTO NAME feature VALUE value),
st AS (SELECT feature, label, count(*) AS n,
              quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
              quantile_cont(value, 0.75) AS q3, min(value) AS min_value, max(value) AS max_value
       FROM long WHERE label IS NOT NULL GROUP BY feature, label),
st2 AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_fence, q3 + 1.5 * (q3 - q1) AS hi_fence
        FROM st)"""

_BOX_SQL = with_views("recipes_d") + "," + _FEATS_D.format(src="recipes_d") + "," + _LONG + """,
ends AS (SELECT l.feature, l.label,
                min(value) FILTER (WHERE value >= lo_fence AND value <= hi_fence) AS whisker_lo,
                max(value) FILTER (WHERE value >= lo_fence AND value <= hi_fence) AS whisker_hi,
                count(*) FILTER (WHERE value < lo_fence OR value > hi_fence) AS n_outliers
         FROM long l JOIN st2 s ON l.feature = s.feature AND l.label = s.label
         GROUP BY l.feature, l.label)
SELECT s.feature, s.label, s.n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(min_value, 6) AS min_value, round(max_value, 6) AS max_value,
       round(whisker_lo, 6) AS whisker_lo, round(whisker_hi, 6) AS whisker_hi, n_outliers
FROM st2 s JOIN ends e ON s.feature = e.feature AND s.label = e.label"""


def _box_out(df):
    return df.select("feature", "label", "n", *[r6(c).alias(c) for c in
                     ["q1", "median", "q3", "min_value", "max_value", "whisker_lo", "whisker_hi"]],
                     "n_outliers")


@register("group_box_stats", _BOX_SQL)
def q_group_box_stats(spark, sf):
    return _box_out(P.group_box_stats(P.profile_features(recipes_d(spark, sf))))


@register("outlier_rows", with_views("recipes_d") + "," + _FEATS_D.format(src="recipes_d") + ","
          + _LONG + """
SELECT l.recipe_id, l.feature, l.label, round(l.value, 6) AS value
FROM long l JOIN st2 s ON l.feature = s.feature AND l.label = s.label
WHERE l.value < s.lo_fence OR l.value > s.hi_fence""")
def q_outlier_rows(spark, sf):
    o = P.outlier_rows(P.profile_features(recipes_d(spark, sf)))
    return o.select("recipe_id", "feature", "label", r6("value").alias("value"))


@register("class_counts", with_views("recipes_d") + """
SELECT label, count(*) AS n_rows FROM recipes_d WHERE label IS NOT NULL GROUP BY label""")
def q_class_counts(spark, sf):
    return P.class_counts(recipes_d(spark, sf))


@register("order_by_label", with_views("recipes_o") + """
SELECT label, count(*) AS n_rows,
       CAST(row_number() OVER (ORDER BY label) AS BIGINT) AS class_order
FROM recipes_o WHERE label IS NOT NULL GROUP BY label""")
def q_order_by_label(spark, sf):
    from pyspark.sql.window import Window
    c = P.class_counts(recipes_o(spark, sf))
    # one row per class: the window runs over the class list, not over rows
    return c.withColumn("class_order", F.row_number().over(Window.orderBy("label")).cast("bigint"))


@register("distinct_labels", with_views("recipes_o") + """
SELECT DISTINCT label FROM recipes_o WHERE label IS NOT NULL""")
def q_distinct_labels(spark, sf):
    return P.distinct_labels(recipes_o(spark, sf))


@register("n_labels", with_views("recipes_d") + """
SELECT count(DISTINCT label) AS n_labels FROM recipes_d""")
def q_n_labels(spark, sf):
    return P.n_labels(recipes_d(spark, sf))


@register("numeric_first_order", with_views("recipes_d", "recipes_ds") + """,
labs AS (SELECT DISTINCT trim(CAST(label AS VARCHAR)) AS label FROM recipes_ds WHERE label IS NOT NULL
         UNION SELECT DISTINCT 'src_' || label FROM recipes_d)
SELECT label, CAST(row_number() OVER (ORDER BY TRY_CAST(label AS BIGINT) ASC NULLS LAST, label) AS BIGINT)
       AS class_order FROM labs""")
def q_numeric_first_order(spark, sf):
    # numeric labels ("0" … "19") mixed with text labels ("src_en" …)
    num = recipes_d(spark, sf, label="source").select(F.trim(F.col("label").cast("string")).alias("label"))
    txt = recipes_d(spark, sf).select(F.concat(F.lit("src_"), "label").alias("label"))
    return P.numeric_first_order(num.unionByName(txt))


@register("trim_label", with_views("recipes_d") + """
SELECT recipe_id, trim(CAST(' ' || label || '  ' AS VARCHAR)) AS label FROM recipes_d""")
def q_trim_label(spark, sf):
    from penmark.functions.columns import trim_label
    d = recipes_d(spark, sf)
    return d.select("recipe_id", trim_label(F.concat(F.lit(" "), "label", F.lit("  "))).alias("label"))


@register("global_quantile", with_views("recipes_d") + """
SELECT CAST(trunc(quantile_cont(length(description), 0.95)) AS BIGINT) AS clip_limit FROM recipes_d""")
def q_global_quantile(spark, sf):
    f = P.profile_features(recipes_d(spark, sf))
    return P.global_quantile(f, "len_description")


@register("empty_group_zero", with_views("recipes_d") + "," + _FEATS_D.format(src="""(
    SELECT r.* FROM recipes_d r JOIN labels l ON r.recipe_id = l.doc_id
    WHERE l.toxic = 1 AND l.quality = 0)""") + "," + _LONG + """,
ends AS (SELECT l.feature, l.label,
                min(value) FILTER (WHERE value >= lo_fence AND value <= hi_fence) AS whisker_lo,
                max(value) FILTER (WHERE value >= lo_fence AND value <= hi_fence) AS whisker_hi,
                count(*) FILTER (WHERE value < lo_fence OR value > hi_fence) AS n_outliers
         FROM long l JOIN st2 s ON l.feature = s.feature AND l.label = s.label
         GROUP BY l.feature, l.label),
full_st AS (SELECT s.*, whisker_lo, whisker_hi, n_outliers FROM st2 s JOIN ends e
            ON s.feature = e.feature AND s.label = e.label),
classes AS (SELECT DISTINCT lang AS label FROM documents),
grid AS (SELECT label, unnest(['n_ingredients', 'n_tags', 'n_steps', 'len_recipe_name',
                               'len_description']) AS feature FROM classes)
SELECT g.feature, g.label, CAST(coalesce(n, 1) AS BIGINT) AS n,
       round(coalesce(q1, 0.0), 6) AS q1, round(coalesce(median, 0.0), 6) AS median,
       round(coalesce(q3, 0.0), 6) AS q3, round(coalesce(min_value, 0.0), 6) AS min_value,
       round(coalesce(max_value, 0.0), 6) AS max_value,
       round(coalesce(whisker_lo, 0.0), 6) AS whisker_lo, round(coalesce(whisker_hi, 0.0), 6) AS whisker_hi,
       CAST(coalesce(n_outliers, 0) AS BIGINT) AS n_outliers, iqr IS NULL AS is_empty
FROM grid g LEFT JOIN full_st f ON g.feature = f.feature AND g.label = f.label""")
def q_empty_group_zero(spark, sf):
    d = recipes_d(spark, sf)
    lab = table(spark, sf, "labels").where("toxic = 1 AND quality = 0")
    sub = d.join(lab, d.recipe_id == lab.doc_id, "left_semi")
    st = P.group_box_stats(P.profile_features(sub))
    classes = table(spark, sf, "documents").select(F.col("lang").alias("label")).distinct()
    out = P.empty_group_zero(st, classes, P.BOX_FEATURES)
    return out.select("feature", "label", "n", *[r6(c).alias(c) for c in
                      ["q1", "median", "q3", "min_value", "max_value", "whisker_lo", "whisker_hi"]],
                      "n_outliers", "is_empty")
