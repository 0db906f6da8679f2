"""Column plumbing: numeric coercion with defaults, absent columns, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penmark.functions.features import empty_string_array, list_count


#: A decimal number as a table reader takes it: no type suffix, no hexadecimal.
NUMBER = r"\A[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\z"
_SPACE = r"[\s\p{Z}\x{85}\x{1C}-\x{1F}]"


def strip_space(c: str | Column) -> Column:
    """Cut all white space at both ends, not blanks alone."""
    col = F.col(c) if isinstance(c, str) else c
    ends = F.concat(F.substring(col, 1, 1), F.substring(col, -1, 1))    # most cells need no search from end to end
    return F.when(ends.rlike(_SPACE), F.regexp_replace(col, rf"\A{_SPACE}++|(?<!{_SPACE}){_SPACE}++\z", "")).otherwise(col)


def coerce_double_default(c: str | Column, default: float = 0.0) -> Column:
    """Numeric parse of any cell; NULL, NaN or unparseable becomes ``default``."""
    col = F.col(c) if isinstance(c, str) else c
    text = strip_space(col.cast("string"))
    return F.coalesce(F.when(text.rlike(NUMBER), text.try_cast("double")), F.lit(float(default)))


def coerce_int_default(c: str | Column, default: int = 0) -> Column:
    """As :func:`coerce_double_default`, truncated toward zero (``7.9`` → 7)."""
    return F.coalesce(coerce_double_default(c, float(default)).try_cast("bigint"),
                      F.lit(int(default)).cast("bigint"))


def ensure_numeric_col(df: DataFrame, col: str, default: float = 0.0) -> DataFrame:
    """Add ``col`` as ``default`` when absent, else coerce it to double."""
    if col not in df.columns:
        return df.withColumn(col, F.lit(float(default)))
    return df.withColumn(col, coerce_double_default(col, default))


def default_list_column(df: DataFrame, col: str) -> DataFrame:
    """An absent list column becomes empty lists on every row."""
    if col in df.columns:
        return df
    return df.withColumn(col, empty_string_array())


def derive_count_if_absent(df: DataFrame, count_col: str = "n_ingredients",
                           list_col: str = "ingredients") -> DataFrame:
    """Use the file's count when present (coerced, truncated), else count the list."""
    if count_col in df.columns:
        return df.withColumn(count_col, coerce_int_default(count_col))
    return df.withColumn(count_col, list_count(list_col))


def trim_label(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return strip_space(col.cast("string"))


def numeric_first_key() -> list[Column]:
    """Sort key: numeric labels by value first, the rest as text."""
    return [F.col("label").try_cast("bigint").asc_nulls_last(), F.col("label").asc()]
