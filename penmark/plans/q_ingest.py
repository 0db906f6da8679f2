"""Registered ingest, list-parsing and sink queries.

The files are written by Spark from the test tables into the shared
checkpoint folder and read back, so each query's work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from penmark.functions import features as FT
from penmark.functions.lists import parse_list_tolerant, parse_lists_strict, parse_lists_tolerant, to_list_literal
from penmark.operators import profile as P
from penmark.plans.catalog import register
from penmark.session import cut_lineage, scratch_path
from penmark.sources.csv_scan import scan_inferred, scan_strict, scan_tolerant, write_recipes_csv
from penmark.sources.fixtures import recipes_d, recipes_o, table, with_views
from penmark.sources.sinks import csv_cell, sink_predictions, write_lines_with_header

COLS = ["recipe_id", "label", "recipe_name", "description", "tags", "steps", "ingredients",
        "n_ingredients", "data"]


@register("scan_strict", with_views("recipes_o") + """
SELECT recipe_id, label, nullif(recipe_name, '') AS recipe_name, nullif(description, '') AS description,
       n_ingredients, CAST(CAST(data AS DATE) AS VARCHAR) AS data,
       array_to_string(tags, '|') AS tags, array_to_string(steps, '|') AS steps,
       array_to_string(ingredients, '|') AS ingredients FROM recipes_o""")
def q_scan_strict(spark, sf):
    # empty text cells come back missing, as a pandas reader gives them
    path = write_recipes_csv(recipes_o(spark, sf).select(*COLS), scratch_path(spark, "strict-o"))
    r = scan_strict(spark, path)
    return r.select("recipe_id", "label", "recipe_name", "description", "n_ingredients",
                    F.col("data").cast("string").alias("data"),
                    *[F.array_join(c, "|").alias(c) for c in ["tags", "steps", "ingredients"]])


@register("scan_strict_text", with_views("recipes_d") + """
SELECT recipe_id, label, md5(recipe_name) AS name_md5, md5(description) AS description_md5,
       md5(array_to_string(steps, chr(10))) AS steps_md5, CAST(len(steps) AS BIGINT) AS n_steps,
       CAST(CAST(data AS DATE) AS VARCHAR) AS data FROM recipes_d""")
def q_scan_strict_text(spark, sf):
    d = recipes_d(spark, sf, even=True).select(*[c for c in COLS if c != "n_ingredients"])
    path = write_recipes_csv(d, scratch_path(spark, "strict-d"))
    r = scan_strict(spark, path, types={"recipe_id": "bigint"})
    return r.select("recipe_id", "label", F.md5("recipe_name").alias("name_md5"),
                    F.md5("description").alias("description_md5"),
                    F.md5(F.array_join("steps", "\n")).alias("steps_md5"),
                    FT.list_count("steps").alias("n_steps"), F.col("data").cast("string").alias("data"))


def _styled(col: str):
    """List cell text in a style picked by the label (1 literal, 2 JSON, 3 bare
    commas, 4 tuple, 5 braces) — the shapes a hand-edited file holds."""
    q = F.transform(col, lambda x: F.concat(F.lit("'"), x, F.lit("'")))
    return (F.when(F.col("label") == 1, to_list_literal(col))
            .when(F.col("label") == 2, F.to_json(col))
            .when(F.col("label") == 3, F.array_join(col, ", "))
            .when(F.col("label") == 4, F.concat(F.lit("("), F.array_join(q, ", "), F.lit(")")))
            .otherwise(F.concat(F.lit("{"), F.array_join(col, ", "), F.lit("}"))))


def write_junk_file(spark, sf) -> str:
    """recipes_o as a hand-edited file: mixed list styles, a padded header
    name, and one extra cell on the rows of orders without lines."""
    o = recipes_o(spark, sf)
    cells = [csv_cell(F.col("recipe_id")), csv_cell(F.col("label")), csv_cell(F.col("recipe_name")),
             csv_cell(_styled("tags")), csv_cell(_styled("steps")), csv_cell(_styled("ingredients")),
             csv_cell(F.col("n_ingredients")), csv_cell(F.date_format("data", "d/M/yyyy"))]
    line = F.concat_ws(";", *cells)
    line = F.when(F.col("n_ingredients") == 0, F.concat(line, F.lit(";extra"))).otherwise(line)
    header = "recipe_id;label;recipe_name; tags ;steps;ingredients;n_ingredients;data"
    return write_lines_with_header(o.select(line.alias("value")), header, scratch_path(spark, "tolerant-o"))


def _count_sql(c: str, alias: str | None = None) -> str:
    return (f"CAST(CASE WHEN label IN (1, 2) THEN len({c}) WHEN label IN (3, 4) AND len({c}) >= 2 "
            f"THEN len({c}) ELSE 0 END AS BIGINT) AS {alias or 'n_' + c}")


@register("scan_tolerant", with_views("recipes_o") + f"""
SELECT CAST(recipe_id AS VARCHAR) AS recipe_id, CAST(label AS VARCHAR) AS label, recipe_name,
       {_count_sql('tags')}, {_count_sql('steps')}, {_count_sql('ingredients', 'n_ingredients_list')},
       CAST(n_ingredients AS VARCHAR) AS n_ingredients, strftime(data, '%-d/%-m/%Y') AS data
FROM recipes_o WHERE n_ingredients > 0""")
def q_scan_tolerant(spark, sf):
    t = scan_tolerant(spark, write_junk_file(spark, sf))
    return t.select("recipe_id", "label", "recipe_name", FT.list_count("tags").alias("n_tags"),
                    FT.list_count("steps").alias("n_steps"),
                    FT.list_count("ingredients").alias("n_ingredients"), "n_ingredients", "data") \
        .toDF("recipe_id", "label", "recipe_name", "n_tags", "n_steps", "n_ingredients_list",
              "n_ingredients", "data")


@register("scan_inferred", with_views("recipes_o") + """
SELECT label, count(*) AS n_rows FROM recipes_o WHERE n_ingredients > 0 GROUP BY label""")
def q_scan_inferred(spark, sf):
    inf = scan_inferred(spark, write_junk_file(spark, sf))
    return P.class_counts(inf)


@register("parse_list_tolerant", with_views("recipes_o") + f"""
SELECT recipe_id, {_count_sql('tags')}, {_count_sql('steps')}, {_count_sql('ingredients')} FROM recipes_o""")
def q_parse_list_tolerant(spark, sf):
    o = recipes_o(spark, sf)
    # the parser reads its input for each of its branches
    cells = cut_lineage(o.select("recipe_id", *[_styled(c).alias(c) for c in ["tags", "steps", "ingredients"]]), "cells")
    lists = parse_lists_tolerant(cells, ["tags", "steps", "ingredients"])
    return lists.select("recipe_id", *[FT.list_count(c).alias(f"n_{c}") for c in ["tags", "steps", "ingredients"]])


@register("parse_list_strict", with_views("recipes_d") + """
SELECT recipe_id, md5(array_to_string(steps, chr(10))) AS steps_md5, CAST(len(steps) AS BIGINT) AS n_steps,
       array_to_string(ingredients, '|') AS ingredients FROM recipes_d""")
def q_parse_list_strict(spark, sf):
    d = recipes_d(spark, sf, even=True).select("recipe_id", to_list_literal("steps").alias("s"),
                                    F.to_json("ingredients").alias("i"))
    p = parse_lists_strict(d.select("recipe_id", F.col("s").alias("steps"), F.col("i").alias("ingredients")), ["steps", "ingredients"])
    return p.select("recipe_id", F.md5(F.array_join("steps", "\n")).alias("steps_md5"),
                    FT.list_count("steps").alias("n_steps"), F.array_join("ingredients", "|").alias("ingredients"))


@register("list_guard_count", with_views("recipes_o") + """
SELECT recipe_id, CAST(CASE WHEN label = 5 THEN 0 ELSE len(tags) END AS BIGINT) AS n_tags FROM recipes_o""")
def q_list_guard_count(spark, sf):
    # label 5 rows hold a literal that is not a list (a number): counted as 0
    o = recipes_o(spark, sf)
    cell = F.when(F.col("label") == 5, F.col("n_ingredients").cast("string")).otherwise(to_list_literal("tags"))
    return o.select("recipe_id", FT.list_count(parse_list_tolerant(cell)).alias("n_tags"))


@register("sink_predictions", """
SELECT doc_id AS row_id, lang AS prediction FROM documents""")
def q_sink_predictions(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), F.col("lang").alias("prediction"))
    back = sink_predictions(d, scratch_path(spark, "pred"), text_path=scratch_path(spark, "pred-txt"))
    return back.select("row_id", "prediction")
