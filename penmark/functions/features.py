"""Column-level feature expressions.

Every function returns a Column (or a DataFrame with columns added) built only
from Spark's own expressions, so whole-stage codegen covers them and Catalyst
can prune and push down around them.  No Python runs per row here.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for the same results.
DAYS_PER_YEAR = 365.25                       # cyclic date period
TEXT_COLUMNS = ["recipe_name", "description"]  # text part of the combined text, in order
LIST_COLUMNS = ["ingredients", "steps", "tags"]  # list part of the combined text, in order
NORM_COLUMNS = ["n_ingredients", "n_tags", "n_steps",
                "len_recipe_name", "len_description", "year"]
ENGINEERED_FEATURES = ["norm_n_ingredients", "norm_n_tags", "norm_n_steps",
                       "norm_len_recipe_name", "norm_len_description", "norm_year",
                       "day_sin", "day_cos"]


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_string_array() -> Column:
    return F.expr("cast(array() as array<string>)")


def list_or_empty(c: str | Column) -> Column:
    """A list column with NULL read as the empty list."""
    return F.coalesce(_c(c), empty_string_array())


def text_concat(text_cols: Sequence[str], list_cols: Sequence[str]) -> Column:
    """Text columns joined by blanks, then each list joined by blanks.

    Each list adds its separating blank even when it is empty, as the reference
    does (``concat_ws`` would skip an empty array, ``array_join`` of an empty
    array is the empty string and keeps the blank).  NULL text is ''.
    """
    parts = [F.coalesce(_c(c), F.lit("")) for c in text_cols]
    parts += [F.array_join(list_or_empty(c), " ") for c in list_cols]
    return F.concat_ws(" ", *parts)


def list_count(c: str | Column) -> Column:
    """Number of items; 0 for a NULL or non-list cell."""
    return F.when(_c(c).isNull(), F.lit(0)).otherwise(F.size(_c(c))).cast("bigint")


def text_length(c: str | Column) -> Column:
    """Length in code points (``length`` counts characters, not bytes)."""
    return F.length(F.coalesce(_c(c), F.lit(""))).cast("bigint")


def date_year(c: str | Column) -> Column:
    return F.year(_c(c)).cast("bigint")


def day_angle(c: str | Column) -> Column:
    return F.lit(2.0 * math.pi) * F.dayofyear(_c(c)) / F.lit(DAYS_PER_YEAR)


def date_sin(c: str | Column) -> Column:
    return F.sin(day_angle(c))


def date_cos(c: str | Column) -> Column:
    return F.cos(day_angle(c))


def date_parse_dayfirst(c: str | Column, formats: Sequence[str] = ("d/M/yyyy", "d-M-yyyy",
                                                                    "d.M.yyyy", "yyyy-MM-dd")) -> Column:
    """Day-first date text to DATE; the first format that parses wins, else NULL."""
    return F.coalesce(*[F.try_to_timestamp(F.trim(_c(c)), F.lit(f)) for f in formats]).cast("date")


def add_text_column(df: DataFrame, text_cols: Sequence[str] = TEXT_COLUMNS,
                    list_cols: Sequence[str] = LIST_COLUMNS, out: str = "text") -> DataFrame:
    return df.withColumn(out, text_concat(text_cols, list_cols))


def add_count_columns(df: DataFrame, list_cols: Sequence[str]) -> DataFrame:
    return df.withColumns({f"n_{c}": list_count(c) for c in list_cols})


def add_length_columns(df: DataFrame, text_cols: Sequence[str]) -> DataFrame:
    return df.withColumns({f"len_{c}": text_length(c) for c in text_cols})


def add_date_features(df: DataFrame, date_col: str) -> DataFrame:
    return df.withColumns({"year": date_year(date_col),
                           "day_sin": date_sin(date_col),
                           "day_cos": date_cos(date_col)})


def add_softmax(df: DataFrame, logits: str | Column, out: str) -> DataFrame:
    """Row-wise softmax of an array of logits into ``out``, shifted by the row max.

    Staged columns so the row max and the normaliser are computed once per
    row; nesting them inside the element lambda would recompute them for
    every element.
    """
    a, m, ex, s = (f"__{out}_{k}" for k in ("a", "m", "e", "s"))
    return (df.withColumn(a, _c(logits).cast("array<double>"))
            .withColumn(m, F.array_max(a))
            .withColumn(ex, F.transform(a, lambda x: F.exp(x - F.col(m))))
            .withColumn(s, F.aggregate(ex, F.lit(0.0), lambda acc, x: acc + x))
            .withColumn(out, F.transform(ex, lambda x: x / F.col(s)))
            .drop(a, m, ex, s))


def argmax(c: str | Column) -> Column:
    """0-based index of the largest element (first one on ties)."""
    return (F.array_position(_c(c), F.array_max(_c(c))) - 1).cast("bigint")


def explode_probabilities(c: str | Column, labels: Sequence, prefix: str = "prob_") -> list[Column]:
    """Probability array → one column per label, in class-index order."""
    return [F.try_element_at(_c(c), F.lit(i + 1)).alias(f"{prefix}{lab}")
            for i, lab in enumerate(labels)]


def word_tokens(c: str | Column) -> Column:
    """Lower-cased word tokens of a text (letters and digits), empties dropped."""
    return F.filter(F.split(F.lower(F.coalesce(_c(c), F.lit(""))), r"[^\p{L}\p{N}]+"),
                    lambda x: x != "")


def token_truncate(c: str | Column, max_tokens: int = 512) -> tuple[Column, Column, Column]:
    """Tokens cut to ``max_tokens``, the full token count and a truncation flag."""
    toks = word_tokens(c)
    return (F.slice(toks, 1, max_tokens), F.size(toks).cast("bigint"),
            F.size(toks) > F.lit(max_tokens))
