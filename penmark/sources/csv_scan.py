"""Semicolon-delimited recipe files with list-literal columns.

Three ways in, as the reference has them:

* ``scan_strict`` — typed columns, day-first dates, list literals; any bad
  value fails the job (independent of the session's ANSI setting);
* ``scan_tolerant`` — every column as text, header names trimmed, over-long
  rows skipped, short rows padded with NULL, pandas-style missing tokens;
* ``scan_inferred`` — the tolerant rows with column types inferred by one
  aggregate pass; fails when the label column is absent.

Quoted cells may hold the separator, doubled quotes and newlines; files are
still read in parallel byte ranges (``ranged_csv``), which leaves the cells as
Parquet in the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from penmark.functions.features import LIST_COLUMNS, date_parse_dayfirst
from penmark.functions.lists import parse_lists_strict, parse_lists_tolerant, to_list_literal
from penmark.session import scratch_path
from penmark.sources.ranged_csv import read_rows

# Cell texts pandas reads as missing by default.
PANDAS_NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                    "nan", "null"]
DAYFIRST_FORMAT = "d/M/yyyy"
CSV_OPTS = {"sep": ";", "header": "true", "quote": '"', "escape": '"', "multiLine": "true",
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_recipes_csv(df: DataFrame, path: str, list_cols: Sequence[str] = LIST_COLUMNS,
                      date_cols: Sequence[str] = ("data",), mode: str = "overwrite") -> str:
    """Write a recipe frame the way the reference's files look: lists as
    Python literals, dates day-first, ``;`` separated with a header."""
    out = df.withColumns({c: to_list_literal(c) for c in list_cols if c in df.columns})
    out = out.withColumns({c: F.date_format(c, DAYFIRST_FORMAT) for c in date_cols if c in df.columns})
    out.write.mode(mode).options(**CSV_OPTS).csv(path)
    return path


def header_names(spark: SparkSession, path: str) -> list[str]:
    """Column names of the first file."""
    return spark.read.options(**CSV_OPTS).csv(path).columns


def with_row_key(df: DataFrame, names: Sequence[str], id_col: str) -> DataFrame:
    """Number the rows in file order where the file has no key."""
    return df if id_col in names else df.withColumn(id_col, F.col("__pm_row") - 1)


def scan_strict(spark: SparkSession, path: str,
                types: Mapping[str, str] | None = None, label: str = "label", id_col: str = "recipe_id",
                date_cols: Sequence[str] = ("data",),
                list_cols: Sequence[str] = LIST_COLUMNS) -> DataFrame:
    """Typed read; any malformed row, uncastable value, bad date or list fails.

    ``types`` maps column → Spark type for the non-text columns (default: the
    ``label``, id and ingredient count as bigint); other columns stay text.  A
    file without ``id_col`` gets its rows numbered in file order.
    """
    types = dict(types or {label: "bigint", id_col: "bigint", "n_ingredients": "bigint"})
    names = header_names(spark, path)
    rows = read_rows(spark, path, len(names))
    bad = F.raise_error(F.concat(F.lit("bad row: "), F.col("n_cells").cast("string"), F.lit(f" cells where {len(names)} are due")))
    rows = rows.where(F.when(F.col("n_cells") == len(names), F.lit(True)).otherwise(bad.cast("boolean")))
    raw = rows.select(F.col("row").alias("__pm_row"), *[F.nullif(F.col(f"c{i}"), F.lit("")).alias(n) for i, n in enumerate(names)])
    raw = with_row_key(raw, names, id_col).drop("__pm_row")
    if id_col not in names:
        types.pop(id_col, None)
    cols = {}
    for c, t in types.items():
        if c in raw.columns:
            v = F.col(c).try_cast(t)
            cols[c] = F.when(v.isNull(), F.raise_error(
                F.concat(F.lit(f"bad {t} in {c}: "), F.coalesce(F.col(c), F.lit("NULL")))).cast(t)).otherwise(v)
    for c in date_cols:
        if c in raw.columns:
            d = date_parse_dayfirst(c)
            cols[c] = F.when(F.col(c).isNotNull() & d.isNull(), F.raise_error(
                F.concat(F.lit(f"bad date in {c}: "), F.col(c))).cast("date")).otherwise(d)
    return parse_lists_strict(raw, list_cols).withColumns(cols)


def scan_tolerant(spark: SparkSession, path: str,
                  null_tokens: Sequence[str] = PANDAS_NA_TOKENS,
                  list_cols: Sequence[str] = LIST_COLUMNS) -> DataFrame:
    """All-text read: trimmed header names, over-long rows skipped, short rows
    kept with NULLs, missing tokens as NULL, list columns parsed tolerantly
    (absent list columns become empty lists)."""
    names = [c.strip() for c in header_names(spark, path)]
    rows = read_rows(spark, path, len(names)).where(F.col("n_cells") <= len(names))
    df = rows.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
    tokens = list(null_tokens)
    df = df.withColumns({n: F.when(F.col(n).isin(*tokens), F.lit(None)).otherwise(F.col(n)) for n in names})
    empty = F.expr("cast(array() as array<string>)")
    return parse_lists_tolerant(df, list_cols).withColumns({c: empty for c in list_cols if c not in names})


#: What no whole number holds; a failed cast costs far more than the search for it.
NO_INTEGER = r"[A-Za-z/:,;'\"]"
#: All that is read as a number with a fraction, and more.
LIKE_DOUBLE = r"(?i)\A[\x00-\x20]*+[-+]?(?:[0-9.][0-9A-FXP.+-]*+|inf(?:inity)?|nan)[\x00-\x20]*+\z"


def infer_types(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """bigint when every cell parses as an integer (and none is missing),
    double when every non-missing cell parses as a number, else string.
    One aggregate pass over all columns; the result is one row."""
    aggs = []
    for c in columns:
        aggs += [F.count(F.lit(1)).alias(f"{c}__rows"), F.count(c).alias(f"{c}__n"),
                 F.count(F.when(~F.col(c).rlike(NO_INTEGER), F.col(c).try_cast("bigint"))).alias(f"{c}__i"),
                 F.count(F.when(F.col(c).rlike(LIKE_DOUBLE), F.col(c).try_cast("double"))).alias(f"{c}__d")]
    r = df.agg(*aggs).first()
    out = {}
    for c in columns:
        rows, n, i, d = (r[f"{c}__{k}"] for k in ("rows", "n", "i", "d"))
        out[c] = ("bigint" if n > 0 and i == n == rows else
                  "double" if n > 0 and d == n else "string")
    return out


def scan_inferred(spark: SparkSession, path: str, label: str = "label") -> DataFrame:
    """Tolerant rows with inferred column types; fails without ``label``."""
    df = scan_tolerant(spark, path, list_cols=())
    if label not in df.columns:
        raise RuntimeError(f"cannot infer types: no column named {label}")
    text_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    types = infer_types(df, text_cols)
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if t != "string"})


def stage(df: DataFrame, name: str = "staged", partitions: int | None = None) -> DataFrame:
    """Write once to Parquet in the shared checkpoint folder, in as many parts as
    the session runs tasks at once unless told otherwise, and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    out = df.repartition(partitions or spark.sparkContext.defaultParallelism)
    out.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
