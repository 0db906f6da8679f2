"""Registered feature and column-plumbing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from penmark.functions import columns as C
from penmark.functions import features as FT
from penmark.operators import dataset as D
from penmark.operators.featurize import engineer, feature_extraction
from penmark.operators.joins import hconcat_by_key
from penmark.operators.scaling import minmax_fit
from penmark.plans.catalog import r6, register
from penmark.plans.q_dataset import split_sql
from penmark.sources.fixtures import recipes_d, recipes_o, table, with_views


@register("text_concat", with_views("recipes_o") + """
SELECT recipe_id, concat_ws(' ', coalesce(recipe_name, ''), coalesce(description, ''),
       array_to_string(ingredients, ' '), array_to_string(steps, ' '), array_to_string(tags, ' ')) AS text
FROM recipes_o""")
def q_text_concat(spark, sf):
    o = recipes_o(spark, sf)
    return FT.add_text_column(o).select("recipe_id", "text")


@register("text_concat_long", with_views("recipes_d") + """
SELECT recipe_id, md5(concat_ws(' ', coalesce(recipe_name, ''), coalesce(description, ''),
       array_to_string(ingredients, ' '), array_to_string(steps, ' '), array_to_string(tags, ' '))) AS text_md5,
       CAST(length(concat_ws(' ', coalesce(recipe_name, ''), coalesce(description, ''),
       array_to_string(ingredients, ' '), array_to_string(steps, ' '), array_to_string(tags, ' '))) AS BIGINT) AS text_len
FROM recipes_d""")
def q_text_concat_long(spark, sf):
    d = FT.add_text_column(recipes_d(spark, sf))
    return d.select("recipe_id", F.md5("text").alias("text_md5"), F.length("text").cast("bigint").alias("text_len"))


@register("list_count", with_views("recipes_o") + """
SELECT recipe_id, CAST(len(tags) AS BIGINT) AS n_tags, CAST(len(steps) AS BIGINT) AS n_steps,
       CAST(len(ingredients) AS BIGINT) AS n_ingredients_list FROM recipes_o""")
def q_list_count(spark, sf):
    o = recipes_o(spark, sf)
    return o.select("recipe_id", FT.list_count("tags").alias("n_tags"), FT.list_count("steps").alias("n_steps"),
                    FT.list_count("ingredients").alias("n_ingredients_list"))


@register("text_length", with_views("recipes_d") + """
SELECT recipe_id, CAST(length(recipe_name) AS BIGINT) AS len_recipe_name,
       CAST(length(description) AS BIGINT) AS len_description FROM recipes_d""")
def q_text_length(spark, sf):
    return FT.add_length_columns(recipes_d(spark, sf), ["recipe_name", "description"]) \
        .select("recipe_id", "len_recipe_name", "len_description")


@register("date_year", """
SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS year FROM orders""")
def q_date_year(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", FT.date_year("o_orderdate").alias("year"))


@register("date_cyclic", with_views("recipes_d") + """
SELECT recipe_id, round(sin(2 * pi() * dayofyear(data) / 365.25), 6) AS day_sin,
       round(cos(2 * pi() * dayofyear(data) / 365.25), 6) AS day_cos FROM recipes_d""")
def q_date_cyclic(spark, sf):
    d = recipes_d(spark, sf)
    return d.select("recipe_id", r6(FT.date_sin("data")).alias("day_sin"),
                    r6(FT.date_cos("data")).alias("day_cos"))


@register("date_parse_dayfirst", """
SELECT o_orderkey, strftime(o_orderdate, '%-d/%-m/%Y') AS raw,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS parsed FROM orders""")
def q_date_parse_dayfirst(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "d/M/yyyy").alias("raw"))
    return o.select("o_orderkey", "raw", FT.date_parse_dayfirst("raw").cast("string").alias("parsed"))


_FEATS_O = """
feats AS (SELECT recipe_id, split,
                 CAST(n_ingredients AS DOUBLE) AS n_ingredients, CAST(len(tags) AS DOUBLE) AS n_tags,
                 CAST(len(steps) AS DOUBLE) AS n_steps,
                 CAST(length(recipe_name) AS DOUBLE) AS len_recipe_name,
                 CAST(length(description) AS DOUBLE) AS len_description,
                 CAST(year(data) AS DOUBLE) AS year,
                 sin(2 * pi() * dayofyear(data) / 365.25) AS day_sin,
                 cos(2 * pi() * dayofyear(data) / 365.25) AS day_cos
          FROM splitted),
b AS (SELECT min(n_ingredients) AS lo1, max(n_ingredients) AS hi1, min(n_tags) AS lo2, max(n_tags) AS hi2,
             min(n_steps) AS lo3, max(n_steps) AS hi3, min(len_recipe_name) AS lo4, max(len_recipe_name) AS hi4,
             min(len_description) AS lo5, max(len_description) AS hi5, min(year) AS lo6, max(year) AS hi6
      FROM feats WHERE split = 'train')"""


def _norm_sql(x: str, i: int) -> str:
    return (f"round(CASE WHEN hi{i} = lo{i} THEN (CASE WHEN {x} > hi{i} THEN 1.0 ELSE 0.0 END) "
            f"ELSE greatest(least(({x} - lo{i}) / (hi{i} - lo{i}), 1.0), 0.0) END, 6) AS norm_{x}")


_NORM_SELECT = ", ".join(_norm_sql(x, i + 1) for i, x in enumerate(FT.NORM_COLUMNS))


@register("minmax_fit", with_views("recipes_o") + ",\n" + split_sql("recipes_o") + "," + _FEATS_O + """
SELECT * FROM b""")
def q_minmax_fit(spark, sf):
    e = engineer(D.stratified_split(recipes_o(spark, sf)))
    fit = minmax_fit(e, FT.NORM_COLUMNS, where=F.col("split") == "train")
    names = ["lo", "hi"]
    return fit.select(*[F.col(f"{m}_{c}").alias(f"{n}{i + 1}") for i, c in enumerate(FT.NORM_COLUMNS)
                        for m, n in zip(["min", "max"], names)])


@register("minmax_apply", with_views("recipes_o") + ",\n" + split_sql("recipes_o") + "," + _FEATS_O + f"""
SELECT recipe_id, {_NORM_SELECT} FROM feats, b""")
def q_minmax_apply(spark, sf):
    f, _ = feature_extraction(D.stratified_split(recipes_o(spark, sf)))
    return f.select("recipe_id", *[r6(f"norm_{c}").alias(f"norm_{c}") for c in FT.NORM_COLUMNS])


@register("feature_extraction", with_views("recipes_o") + ",\n" + split_sql("recipes_o") + "," + _FEATS_O + f"""
SELECT recipe_id, split, {_NORM_SELECT}, round(day_sin, 6) AS day_sin, round(day_cos, 6) AS day_cos
FROM feats, b""")
def q_feature_extraction(spark, sf):
    f, _ = feature_extraction(D.stratified_split(recipes_o(spark, sf)))
    return f.select("recipe_id", "split", *[r6(c).alias(c) for c in FT.ENGINEERED_FEATURES])


@register("project_features", with_views("recipes_o") + ",\n" + split_sql("recipes_o") + "," + _FEATS_O + f"""
SELECT recipe_id, {_NORM_SELECT}, round(day_sin, 6) AS day_sin, round(day_cos, 6) AS day_cos
FROM feats, b""")
def q_project_features(spark, sf):
    f, _ = feature_extraction(D.stratified_split(recipes_o(spark, sf)))
    return f.select("recipe_id", *[r6(c).alias(c) for c in FT.ENGINEERED_FEATURES])


@register("filter_class", with_views("recipes_d") + """
SELECT recipe_id, CAST(length(description) AS BIGINT) AS len_description FROM recipes_d WHERE label = 'fr'""")
def q_filter_class(spark, sf):
    d = recipes_d(spark, sf).where(F.col("label") == "fr")
    return d.select("recipe_id", FT.text_length("description").alias("len_description"))


_RAW_CELL_SQL = """CASE WHEN event_id % 40 = 0 THEN 'NaN' WHEN event_id % 40 = 1 THEN CAST(value AS VARCHAR) || 'd'
                        WHEN event_id % 40 = 2 THEN '0x1p3' WHEN event_id % 40 = 3 THEN chr(9) || CAST(value AS VARCHAR) || chr(10)
                        WHEN event_type = 'click' THEN CAST(value AS VARCHAR)
                        WHEN event_type = 'error' THEN 'x' || CAST(value AS VARCHAR)
                        WHEN event_type = 'view' THEN ' ' || CAST(value AS VARCHAR) || ' '
                        ELSE NULL END"""


def _raw_cell():
    v = F.col("value").cast("string")
    rest = F.col("event_id") % 40
    return (F.when(rest == 0, F.lit("NaN")).when(rest == 1, F.concat(v, F.lit("d"))).when(rest == 2, F.lit("0x1p3"))
            .when(rest == 3, F.concat(F.lit("\t"), v, F.lit("\n")))
            .when(F.col("event_type") == "click", v)
            .when(F.col("event_type") == "error", F.concat(F.lit("x"), v))
            .when(F.col("event_type") == "view", F.concat(F.lit(" "), v, F.lit(" "))))


_NUMBER_SQL = f"""CASE WHEN regexp_full_match(trim({_RAW_CELL_SQL}, ' ' || chr(9) || chr(10)),
                  '[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?')
                  THEN CAST(trim({_RAW_CELL_SQL}, ' ' || chr(9) || chr(10)) AS DOUBLE) END"""


@register("coerce_int_default", f"""
SELECT event_id, CAST(coalesce(trunc({_NUMBER_SQL}), 0) AS BIGINT) AS n FROM events""")
def q_coerce_int_default(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", C.coerce_int_default(_raw_cell()).alias("n"))


@register("coerce_double_default", f"""
SELECT event_id, round(coalesce({_NUMBER_SQL}, 0.0), 6) AS x FROM events""")
def q_coerce_double_default(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", r6(C.coerce_double_default(_raw_cell())).alias("x"))


@register("ensure_numeric_col", with_views("recipes_o") + """
SELECT recipe_id, CAST(n_ingredients AS DOUBLE) AS n_ingredients, 0.0 AS rating FROM recipes_o""")
def q_ensure_numeric_col(spark, sf):
    o = recipes_o(spark, sf).select("recipe_id", "n_ingredients")
    o = C.ensure_numeric_col(C.ensure_numeric_col(o, "n_ingredients"), "rating")
    return o.select("recipe_id", "n_ingredients", "rating")


@register("default_list_column", with_views("recipes_o") + """
SELECT recipe_id, CAST(0 AS BIGINT) AS n_tags, CAST(len(steps) AS BIGINT) AS n_steps FROM recipes_o""")
def q_default_list_column(spark, sf):
    o = recipes_o(spark, sf).drop("tags")
    o = C.default_list_column(C.default_list_column(o, "tags"), "steps")
    return o.select("recipe_id", FT.list_count("tags").alias("n_tags"), FT.list_count("steps").alias("n_steps"))


@register("derive_count_if_absent", with_views("recipes_d", "recipes_o") + """
SELECT 'd' AS src, recipe_id, CAST(len(ingredients) AS BIGINT) AS n_ingredients FROM recipes_d
UNION ALL SELECT 'o' AS src, recipe_id, n_ingredients FROM recipes_o""")
def q_derive_count_if_absent(spark, sf):
    d = C.derive_count_if_absent(recipes_d(spark, sf)).select(F.lit("d").alias("src"), "recipe_id", "n_ingredients")
    o = C.derive_count_if_absent(recipes_o(spark, sf)).select(F.lit("o").alias("src"), "recipe_id", "n_ingredients")
    return d.unionByName(o)


@register("hconcat_by_key", """
SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def q_hconcat_by_key(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    lab = table(spark, sf, "labels")
    return hconcat_by_key(d, lab, "doc_id").select("doc_id", "lang", "quality", "toxic")


_SOFTMAX_SQL = """
sm AS (SELECT vec_id, label, list_transform(e, lambda x: exp(x * 10.0 - list_max(e) * 10.0)) AS ex
       FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)),
pr AS (SELECT vec_id, label, list_transform(ex, lambda x: x / list_sum(ex)) AS p FROM sm)"""


@register("softmax_scores", "WITH " + _SOFTMAX_SQL + """
SELECT vec_id, CAST(i AS BIGINT) - 1 AS class_idx, round(p[i], 6) AS prob
FROM (SELECT vec_id, p, generate_subscripts(p, 1) AS i FROM pr)""")
def q_softmax_scores(spark, sf):
    e = table(spark, sf, "embeddings")
    p = FT.add_softmax(e.select("vec_id", F.transform("embedding", lambda x: x * 10.0).alias("z")), "z", "p")
    return p.select("vec_id", F.posexplode_outer("p").alias("class_idx", "prob")) \
        .select("vec_id", F.col("class_idx").cast("bigint").alias("class_idx"), r6("prob").alias("prob"))


@register("argmax_label", """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS argmax FROM embeddings""")
def q_argmax_label(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", FT.argmax("embedding").alias("argmax"))


DIMENSIONS = 64


@register("explode_probabilities", """
WITH sm AS (SELECT vec_id, list_transform(e, lambda x: exp(x * 10.0 - list_max(e) * 10.0)) AS ex
            FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)),
pr AS (SELECT vec_id, list_transform(ex, lambda x: x / list_sum(ex)) AS p FROM sm)
SELECT vec_id, """ + ", ".join(f"round(p[{i + 1}], 6) AS prob_{i}" for i in range(DIMENSIONS)) + " FROM pr")
def q_explode_probabilities(spark, sf):
    e = table(spark, sf, "embeddings")
    labels = list(range(DIMENSIONS))                  # every value is a class's logit
    z = e.select("vec_id", F.transform("embedding", lambda x: x * 10.0).alias("z"))
    p = FT.add_softmax(z, "z", "p")
    return p.select("vec_id", *FT.explode_probabilities("p", labels)) \
        .select("vec_id", *[r6(f"prob_{lab}").alias(f"prob_{lab}") for lab in labels])


@register("token_truncate", """
WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS toks
           FROM documents)
SELECT doc_id, array_to_string(toks[1:512], ' ') AS kept, CAST(len(toks) AS BIGINT) AS n_tokens,
       len(toks) > 512 AS truncated FROM t""")
def q_token_truncate(spark, sf):
    d = table(spark, sf, "documents")
    kept, n, trunc = FT.token_truncate("text", 512)
    return d.select("doc_id", F.array_join(kept, " ").alias("kept"), n.alias("n_tokens"), trunc.alias("truncated"))

