"""Per-class profiling: counts, box statistics, outliers, global quantile.

The reference loops over features × classes and filters the frame each time.
Here the box statistics of all classes and features come from the same few
passes; partial aggregation runs before every shuffle.  Exact percentiles select
by refining histograms (``quantiles``): no task holds a group's values, and a
class with a third of the rows is no single task's work.  ``approx=True`` uses
``percentile_approx`` instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from penmark.functions.columns import coerce_double_default, numeric_first_key, trim_label
from penmark.functions.features import list_count, text_length
from penmark.operators.joins import small_table
from penmark.operators.quantiles import exact_quantiles
from penmark.session import cut_lineage

# Fixed values that must equal the reference's for the same results.
WHISKER = 1.5          # box whiskers at 1.5 × IQR
CLIP_QUANTILE = 0.95   # y-axis limit of the description-length box plot
BOX_FEATURES = ["n_ingredients", "n_tags", "n_steps", "len_recipe_name", "len_description"]


def profile_features(df: DataFrame, label: str = "label") -> DataFrame:
    """Counts and lengths used by the box plots, numeric with 0 for junk.

    ``n_ingredients`` comes from the table when present, else from the list.
    """
    cols = {"n_tags": list_count("tags"), "n_steps": list_count("steps"),
            "len_recipe_name": text_length("recipe_name"),
            "len_description": text_length("description")}
    cols["n_ingredients"] = (coerce_double_default("n_ingredients")
                             if "n_ingredients" in df.columns else list_count("ingredients"))
    out = df.withColumns(cols).withColumn("label", trim_label(label))
    return out.withColumns({f: coerce_double_default(f) for f in BOX_FEATURES})


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per class, NULL labels not counted, ordered by class."""
    return (df.where(F.col(label).isNotNull()).groupBy(label)
            .agg(F.count(F.lit(1)).alias("n_rows")).orderBy(label))


def distinct_labels(df: DataFrame, label: str = "label") -> DataFrame:
    return df.select(label).where(F.col(label).isNotNull()).distinct()


def n_labels(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(F.count_distinct(label).alias("n_labels"))


def numeric_first_order(df: DataFrame, label: str = "label") -> DataFrame:
    """Distinct classes with their display position: numbers by value, then text.

    Runs on the distinct label set (one row per class), never on rows.
    """
    labs = distinct_labels(df.select(F.col(label).alias("label")))
    w = Window.orderBy(*numeric_first_key())
    return labs.withColumn("class_order", F.row_number().over(w).cast("bigint"))


def global_quantile(df: DataFrame, col: str, q: float = CLIP_QUANTILE,
                    approx: bool = False) -> DataFrame:
    """One-row quantile of a column, truncated to an integer (plot limit)."""
    if approx:
        found = df.agg(F.percentile_approx(col, q, 100000).alias("v"))
    else:
        one = exact_quantiles(_narrow(df, [col], []), [col], [], [q]).select(F.col("q")[0].alias("v"))
        found = one.agg(F.max("v").alias("v"))          # a table without values has one row too
    return found.select(F.col("v").cast("double").try_cast("bigint").alias("clip_limit"))


def _narrow(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """The features alone, written once: later passes do not read the text again."""
    return cut_lineage(df.select(*keep, *[F.col(f).cast("double").alias(f) for f in features]), "box")


def _box_wide(rows: DataFrame, features: Sequence[str], label: str, approx: bool) -> DataFrame:
    """One row per class: n and, for each feature f, a struct ``s_f`` of its box
    statistics."""
    qs = [0.25, 0.5, 0.75]
    aggs = [x for f in features for x in (F.min(f).alias(f"lo_{f}"), F.max(f).alias(f"hi_{f}"))]
    if approx:
        aggs += [F.percentile_approx(f, qs, 100000).alias(f"q_{f}") for f in features]
    st = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"), *aggs)
    if not approx:
        q = exact_quantiles(rows, features, [label], qs)
        wide = q.groupBy(label).agg(*[F.max_by("q", F.col("feature") == f).alias(f"q_{f}") for f in features])
        st = st.join(wide, label)

    def box(f: str) -> Column:
        q1, median, q3 = (F.col(f"q_{f}")[i].cast("double") for i in range(3))
        return F.struct(q1.alias("q1"), median.alias("median"), q3.alias("q3"), F.col(f"lo_{f}").alias("min_value"),
                        F.col(f"hi_{f}").alias("max_value"), (q3 - q1).alias("iqr"),
                        (q1 - F.lit(WHISKER) * (q3 - q1)).alias("lo_fence"),
                        (q3 + F.lit(WHISKER) * (q3 - q1)).alias("hi_fence")).alias(f"s_{f}")
    return st.select(label, "n", *[box(f) for f in features])


def group_box_stats(df: DataFrame, features: Sequence[str] = BOX_FEATURES,
                    label: str = "label", approx: bool = False) -> DataFrame:
    """Per feature and class: n, q1, median, q3, whisker ends, outlier count.

    Whiskers end at the most extreme value inside the fences (matplotlib's
    rule).  Two grouped passes over the narrow features, one row per record:
    the percentiles, then the whiskers.  The fences (one row per class) are
    written, measured and broadcast back if small, so rows are never shuffled by
    class and a hot class is no single task's work.
    """
    rows = _narrow(df.where(F.col(label).isNotNull()), features, [label])
    st, _ = small_table(_box_wide(rows, features, label, approx))
    aggs = []
    for f in features:
        inside = (F.col(f) >= F.col(f"s_{f}.lo_fence")) & (F.col(f) <= F.col(f"s_{f}.hi_fence"))
        aggs += [F.min(F.when(inside, F.col(f))).alias(f"lo_{f}"), F.max(F.when(inside, F.col(f))).alias(f"hi_{f}"),
                 F.count(F.when(~inside, F.lit(1))).alias(f"out_{f}")]
    ends = rows.join(st, label).groupBy(label).agg(*aggs)
    each = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"s_{f}").alias("s"), F.col(f"lo_{f}").alias("whisker_lo"),
                              F.col(f"hi_{f}").alias("whisker_hi"), F.col(f"out_{f}").alias("n_outliers")) for f in features])
    return (st.join(ends, label).select(label, "n", F.explode(each).alias("e"))
            .select("e.feature", label, "n", "e.s.*", "e.whisker_lo", "e.whisker_hi", "e.n_outliers"))


def outlier_rows(df: DataFrame, features: Sequence[str] = BOX_FEATURES,
                 label: str = "label", id_col: str = "recipe_id",
                 approx: bool = False) -> DataFrame:
    """Rows drawn beyond the whiskers (fliers): (id, feature, label, value)."""
    rows = _narrow(df.where(F.col(label).isNotNull()), features, [id_col, label])
    st, _ = small_table(_box_wide(rows, features, label, approx))
    each = F.array(*[F.when((F.col(f) < F.col(f"s_{f}.lo_fence")) | (F.col(f) > F.col(f"s_{f}.hi_fence")),
                            F.struct(F.lit(f).alias("feature"), F.col(f).alias("value"))) for f in features])
    return (rows.join(st, label).select(id_col, label, F.explode(F.filter(each, lambda x: x.isNotNull())).alias("e"))
            .select(id_col, "e.feature", label, "e.value"))


def empty_group_zero(stats: DataFrame, classes: DataFrame, features: Sequence[str],
                     label: str = "label") -> DataFrame:
    """Every (feature, class) present; a class with no values gets one 0.0.

    ``classes`` is the full class list (one row per class); the feature list
    is a small literal set, so the frame of all pairs is classes × |features|
    built by an explode, not a join.
    """
    grid = classes.select(label, F.explode(F.array(*[F.lit(f) for f in features])).alias("feature"))
    stat_cols = ["q1", "median", "q3", "min_value", "max_value", "whisker_lo", "whisker_hi"]
    j = grid.join(stats, ["feature", label], "left")
    filled = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in stat_cols}
    filled["n"] = F.coalesce(F.col("n"), F.lit(1)).cast("bigint")
    filled["n_outliers"] = F.coalesce(F.col("n_outliers"), F.lit(0)).cast("bigint")
    filled["is_empty"] = F.col("iqr").isNull()
    return j.withColumns(filled).select("feature", label, "n", *stat_cols, "n_outliers", "is_empty")
