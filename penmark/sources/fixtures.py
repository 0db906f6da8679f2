"""Recipe-shaped views over the driver's test tables.

The reference reads one recipe table (label, name, description, three list
columns, a date).  The test tables hold no such table, so two views derive the
same kinds of columns, with work that grows with the input tables:

* ``recipes_d`` from ``documents``: text, imbalanced learnable label (``lang``);
* ``recipes_o`` from ``orders`` ⟕ (``lineitem`` ⋈ ``part``): lists, dates,
  integer label.

The lists hold no NULL, so ``sort_array`` orders them as ``array_sort`` does, without
its interpreted comparisons.

Each view has a Spark builder and the DuckDB text of the same view for the
oracle (``*_SQL``), kept side by side so they change together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from penmark.session import cut_lineage

#: Rows of a part that is dealt out.
SPREAD_ROWS = 20_000
#: Rows that a job of many passes reads as they lie.
KEPT_ROWS = 5_000
WORD_SPLIT = r"[^\p{L}\p{N}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str, keep: bool = False) -> DataFrame:
    """``df``, dealt out by the hash of ``keys`` if one of its tasks would read more than
    twice its share: a row group, however large, is read by one task.  ``keep``: for a job
    that reads the rows again and again, they are dealt out once and written, if there are
    more than ``KEPT_ROWS``.

    The count of rows that tells reads the files' footers alone."""
    tasks = df.sparkSession.sparkContext.defaultParallelism
    r = df.groupBy(F.spark_partition_id()).count().agg(F.max("count").alias("most"), F.sum("count").alias("n")).first()
    if (r["most"] or 0) * tasks <= 2 * (r["n"] or 0):
        return df
    if keep and r["n"] <= KEPT_ROWS:
        return df
    dealt = df.repartition(max(2 * tasks, r["n"] // SPREAD_ROWS), *keys)
    return cut_lineage(dealt, "dealt") if keep else dealt


def recipes_d(spark: SparkSession, sf_dir: str, label: str = "lang", even: bool = False, keep: bool = False) -> DataFrame:
    """documents → recipe columns; ``even``: the rows are dealt out to all tasks
    before the texts are cut, where the table's row groups do not do that; ``keep``:
    the same, once for all passes of a job.

    label ``lang`` (string, 4 classes) or ``source`` (its number, 20 classes).
    ``tags`` holds only ``source`` so no model sees the label through it.
    """
    d = table(spark, sf_dir, "documents")
    if even or keep:
        d = spread(d.select("doc_id", "text", "lang", "source"), "doc_id", "text", keep=keep)
    first_line = F.substring_index("text", "\n", 1)
    words = F.array_remove(F.split("text", WORD_SPLIT), "")
    lab = (F.col("lang") if label == "lang"
           else F.regexp_extract("source", r"(\d+)", 1).cast("bigint"))
    return d.select(
        F.col("doc_id").alias("recipe_id"),
        lab.alias("label"),
        first_line.alias("recipe_name"),
        F.col("text").alias("description"),
        F.array("source").alias("tags"),
        F.split("text", "\n").alias("steps"),
        F.sort_array(F.array_distinct(words)).alias("ingredients"),
        F.date_add(F.lit("2000-01-01").cast("date"),
                   (F.col("doc_id") % 3653).cast("int")).alias("data"),
    )


def _values(c: str) -> Column:
    """The values of a collected field, without NULL and sorted."""
    return F.sort_array(F.array_compact(c))


def recipes_o(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders ⟕ (lineitem ⋈ part) → recipe columns, one row per order.

    Lines are aggregated per order before the outer join, so the aggregate's
    hash partitioning on the order key is reused by the join (orders is the
    only side that moves).  An order has a bounded number of lines, so the
    sorted lists are bounded too.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    lines = (li.join(p, li.l_partkey == p.p_partkey)
             .groupBy("l_orderkey")
             .agg(F.collect_list(F.struct("p_type", "p_brand", "p_name", F.concat_ws(" ", "p_type", "l_returnflag").alias("step"))).alias("l")))
    lines = lines.select("l_orderkey", F.array_min("l.p_name").alias("min_name"), _values("l.p_type").alias("types"),
                         _values("l.p_brand").alias("tags"), _values("l.step").alias("steps"),
                         _values("l.p_name").alias("ingredients"), F.size("l").alias("n_lines"))
    empty = F.expr("cast(array() as array<string>)")
    return (o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
            .select(F.col("o_orderkey").alias("recipe_id"),
                    F.substring("o_orderpriority", 1, 1).cast("bigint").alias("label"),
                    F.coalesce("min_name", F.lit("")).alias("recipe_name"),
                    F.coalesce(F.array_join("types", " "), F.lit("")).alias("description"),
                    F.coalesce("tags", empty).alias("tags"),
                    F.coalesce("steps", empty).alias("steps"),
                    F.coalesce("ingredients", empty).alias("ingredients"),
                    F.coalesce("n_lines", F.lit(0)).cast("bigint").alias("n_ingredients"),
                    F.col("o_orderdate").alias("data")))


# DuckDB text of the same views (oracle side).
RECIPES_D_SQL = r"""
recipes_d AS (
  SELECT doc_id AS recipe_id,
         lang AS label,
         split_part(text, chr(10), 1) AS recipe_name,
         text AS description,
         [source] AS tags,
         string_split(text, chr(10)) AS steps,
         list_sort(list_distinct(list_filter(
             regexp_split_to_array(text, '[^\p{L}\p{N}]+'),
             lambda x: x <> ''))) AS ingredients,
         date '2000-01-01' + CAST(doc_id % 3653 AS INTEGER) AS data
  FROM documents)"""

RECIPES_DS_SQL = r"""
recipes_ds AS (
  SELECT recipe_id, CAST(regexp_extract(tags[1], '(\d+)', 1) AS BIGINT) AS label,
         recipe_name, description, tags, steps, ingredients, data
  FROM recipes_d)"""

RECIPES_O_SQL = r"""
lines_o AS (
  SELECT l_orderkey,
         min(p_name) AS min_name,
         list_sort(list(p_type)) AS types,
         list_sort(list(p_brand)) AS tags,
         list_sort(list(p_type || ' ' || l_returnflag)) AS steps,
         list_sort(list(p_name)) AS ingredients,
         count(*) AS n_lines
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY l_orderkey),
recipes_o AS (
  SELECT o_orderkey AS recipe_id,
         CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS label,
         coalesce(min_name, '') AS recipe_name,
         coalesce(array_to_string(types, ' '), '') AS description,
         coalesce(tags, CAST([] AS VARCHAR[])) AS tags,
         coalesce(steps, CAST([] AS VARCHAR[])) AS steps,
         coalesce(ingredients, CAST([] AS VARCHAR[])) AS ingredients,
         CAST(coalesce(n_lines, 0) AS BIGINT) AS n_ingredients,
         o_orderdate AS data
  FROM orders LEFT JOIN lines_o ON o_orderkey = l_orderkey)"""


def with_views(*names: str) -> str:
    """``WITH`` prefix holding the named fixture views, in dependency order."""
    parts = {"recipes_d": RECIPES_D_SQL, "recipes_ds": RECIPES_DS_SQL,
             "recipes_o": RECIPES_O_SQL}
    need = list(names)
    if "recipes_ds" in need and "recipes_d" not in need:
        need.insert(0, "recipes_d")
    order = ["recipes_d", "recipes_ds", "recipes_o"]
    return "WITH " + ",".join(parts[n] for n in order if n in need)
