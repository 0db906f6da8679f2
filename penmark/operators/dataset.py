"""Dataset preparation: seeded stratified rank, exact stratified splits,
label encoding, predefined validation fold, refit set, balancing deficits.

Randomness is derived from ``md5(id ‖ '-' ‖ seed)``, never from ``rand()``:
a recomputed partition (lost executor, uncached re-read) yields the same
rows, and the order is identical in any SQL engine with md5.

Skew: a class may hold a third of all rows, so nothing here windows over a
whole class.  Ranks are computed inside (class, md5-prefix bucket)
partitions and offset by the running count of the earlier buckets of their
class, which is computed on a table of at most classes × 16^digits rows.
The split needs no rank per row at all: it broadcasts per-class thresholds
found by ranking only the few buckets that hold a cut, so the wide rows are
labelled where they are read and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


from penmark.operators.joins import small_table
from penmark.session import cut_lineage

HASH_COL = "_h"


def hash_key(id_col: str, seed: int = 42) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"-{seed}")))


def _ranked(df: DataFrame, label: str, id_col: str, seed: int, bucket_digits: int,
            out: str) -> tuple[DataFrame, DataFrame]:
    h = df.withColumn(HASH_COL, hash_key(id_col, seed)) \
          .withColumn("_b", F.substring(HASH_COL, 1, bucket_digits))
    per_bucket = h.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    wcls = Window.partitionBy(label)
    offsets = (per_bucket
               .withColumn("_off", F.coalesce(F.sum("_cnt").over(
                   wcls.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
               .withColumn("class_n", F.sum("_cnt").over(wcls))
               .select(F.col(label).alias("_lab"), F.col("_b").alias("_bb"), "_off", "class_n"))
    joined = h.join(offsets, F.col(label).eqNullSafe(F.col("_lab")) & (F.col("_b") == F.col("_bb")))
    w = Window.partitionBy(label, "_b").orderBy(HASH_COL, id_col)
    ranked = (joined.withColumn(out, (F.col("_off") + F.row_number().over(w) - 1).cast("bigint"))
              .drop("_lab", "_bb", "_off", "_b", HASH_COL)
              .withColumn("class_n", F.col("class_n").cast("bigint")))
    classes = per_bucket.groupBy(label).agg(F.sum("_cnt").cast("bigint").alias("class_n"))
    return ranked, classes


def stratified_rank(df: DataFrame, label: str = "label", id_col: str = "recipe_id",
                    seed: int = 42, bucket_digits: int = 3, out: str = "class_rank") -> DataFrame:
    """0-based seeded position of each row in its class, plus class size ``class_n``.

    Equal to ``row_number() OVER (PARTITION BY label ORDER BY md5, id) - 1``
    but parallel over class × bucket partitions.
    """
    return _ranked(df, label, id_col, seed, bucket_digits, out)[0]


def _allocate(classes: DataFrame, label: str, n_col: str, frac: float, keep: str) -> DataFrame:
    """Per-class held-out counts, exactly as a stratified shuffle split sizes them.

    ``n_out = ceil(n · frac)`` in double arithmetic, the kept part
    ``floor(n_c · n_keep / n)`` per class plus one for the classes with the
    largest remainders (ties by label), computed in integers.  Runs on the
    class table (one row per class).
    """
    tot = Window.partitionBy(F.lit(0))
    c = (classes
         .withColumn("_n", F.sum(n_col).over(tot))
         .withColumn("_nout", F.ceil(F.col("_n").cast("double") * F.lit(float(frac))).cast("bigint"))
         .withColumn("_nkeep", F.col("_n") - F.col("_nout"))
         .withColumn("_prod", F.col(n_col) * F.col("_nkeep"))
         .withColumn("_base", F.expr(f"CAST(_prod div _n AS BIGINT)"))
         .withColumn("_rem", F.col("_prod") - F.col("_base") * F.col("_n"))
         .withColumn("_need", F.col("_nkeep") - F.sum("_base").over(tot))
         .withColumn("_pos", F.row_number().over(tot.orderBy(F.col("_rem").desc(), F.col(label))))
         .withColumn(keep, F.col("_base") + F.when(F.col("_pos") <= F.col("_need"), 1).otherwise(0)))
    return c.drop("_n", "_nout", "_nkeep", "_prod", "_base", "_rem", "_need", "_pos")


def split_sizes_by_class(class_counts: DataFrame, label: str = "label",
                         test_size: float = 0.2, val_size: float = 0.2) -> DataFrame:
    """(label, class_n, n_test, n_val, n_train) for the nested two-way split."""
    a = _allocate(class_counts, label, "class_n", test_size, "_keep1")
    a = a.withColumn("n_test", F.col("class_n") - F.col("_keep1"))
    if val_size > 0:
        b = _allocate(a, label, "_keep1", val_size, "n_train")
        b = b.withColumn("n_val", F.col("_keep1") - F.col("n_train"))
    else:
        b = a.withColumn("n_train", F.col("_keep1")).withColumn("n_val", F.lit(0).cast("bigint"))
    return b.select(label, "class_n", *[F.col(c).cast("bigint").alias(c)
                                        for c in ["n_test", "n_val", "n_train"]])


def _not_after(h: Column, i: Column, th: Column, ti: Column) -> Column:
    """(h, i) ≤ (th, ti) in seeded order; NULL (false in ``when``) without a threshold."""
    return (h < th) | ((h == th) & (i <= ti))


def split_thresholds(df: DataFrame, label: str = "label", id_col: str = "recipe_id",
                     test_size: float = 0.2, val_size: float = 0.2, seed: int = 42,
                     bucket_digits: int = 3) -> DataFrame:
    """Per class, the last test row and the last validation row in seeded order.

    Columns ``(_lab, _th1, _ti1, _th2, _ti2)``: a row is test when its
    ``(md5, id)`` is not after ``(_th1, _ti1)``, else validation when not
    after ``(_th2, _ti2)``; NULL thresholds mean an empty part.  Computed
    from two narrow scans of ``(label, id)`` and never a whole-class window:

    1. rows per (class, md5-prefix bucket) — map-side partial counts;
    2. on that table, each class's split sizes and the bucket holding each
       cut position (running counts over the buckets);
    3. only the rows of those ≤ 2 buckets per class are ranked.

    The table has one row per class; it is written once, so later plans do not
    hold this one, and comes back with a broadcast hint when it is small.
    """
    keyed = df.select(F.col(label).alias("_lab"), F.col(id_col).alias("_id"),
                      hash_key(id_col, seed).alias(HASH_COL))
    keyed = keyed.withColumn("_b", F.substring(HASH_COL, 1, bucket_digits))
    buckets = cut_lineage(keyed.groupBy("_lab", "_b").agg(F.count(F.lit(1)).alias("_cnt")), "buckets")
    classes = buckets.groupBy("_lab").agg(F.sum("_cnt").cast("bigint").alias("class_n"))
    sizes = split_sizes_by_class(classes, "_lab", test_size, val_size)
    # 0-based cut positions: last test row, last validation row (when non-empty)
    cuts = (sizes.select("_lab", F.explode(F.array(
        F.struct(F.lit(1).alias("_which"), (F.col("n_test") - 1).alias("_pos"), F.col("n_test").alias("_len")),
        F.struct(F.lit(2).alias("_which"), (F.col("n_test") + F.col("n_val") - 1).alias("_pos"),
                 F.col("n_val").alias("_len")))).alias("_c"))
        .select("_lab", "_c.*").where(F.col("_len") > 0).drop("_len"))
    run = Window.partitionBy("_lab").orderBy("_b")
    offs = (buckets.withColumn("_end", F.sum("_cnt").over(run.rowsBetween(Window.unboundedPreceding, 0)))
            .select(F.col("_lab").alias("_al"), F.col("_b").alias("_ab"),
                    (F.col("_end") - F.col("_cnt")).alias("_off"), "_end"))
    at = (cuts.join(offs, F.col("_lab").eqNullSafe(F.col("_al"))
                    & (F.col("_pos") >= F.col("_off")) & (F.col("_pos") < F.col("_end")))
          .select("_al", "_ab", "_which", (F.col("_pos") - F.col("_off")).alias("_local")))
    # two rows per class: written, measured, broadcast if small (else the planner and AQE choose)
    at, _ = small_table(at)
    hit, _ = small_table(at.select("_al", "_ab").distinct())
    inside = keyed.join(hit, F.col("_lab").eqNullSafe(F.col("_al")) & (F.col("_b") == F.col("_ab")),
                        "left_semi")
    w = Window.partitionBy("_lab", "_b").orderBy(HASH_COL, "_id")
    ranked = inside.withColumn("_r", F.row_number().over(w) - 1)
    rows = (ranked.join(at, F.col("_lab").eqNullSafe(F.col("_al")) & (F.col("_b") == F.col("_ab"))
                        & (F.col("_r") == F.col("_local")))
            .groupBy("_lab")
            .agg(*[F.max(F.when(F.col("_which") == i, F.col(c))).alias(f"{n}{i}")
                   for i in (1, 2) for c, n in ((HASH_COL, "_th"), ("_id", "_ti"))]))
    thr = sizes.select("_lab").join(rows.withColumnRenamed("_lab", "_rl"),
                                    F.col("_lab").eqNullSafe(F.col("_rl")), "left").drop("_rl")
    thr, _ = small_table(thr)
    return thr


def stratified_split(df: DataFrame, label: str = "label", id_col: str = "recipe_id",
                     test_size: float = 0.2, val_size: float = 0.2, seed: int = 42,
                     out: str = "split") -> DataFrame:
    """Adds ``split`` ∈ {train, val, test}: stratified, seeded, exact sizes.

    The first ``n_test`` rows of each class (in seeded order) are test, the
    next ``n_val`` validation, the rest train; ``val_size=0`` gives a two-way
    split.  Equal to ranking every class, but the wide rows never move: the
    per-class thresholds (:func:`split_thresholds`) are broadcast and each
    row is labelled where it is read.
    """
    thr = split_thresholds(df, label, id_col, test_size, val_size, seed)
    h, i = F.col(HASH_COL), F.col(id_col)
    j = df.withColumn(HASH_COL, hash_key(id_col, seed)).join(thr, F.col(label).eqNullSafe(F.col("_lab")))
    return (j.withColumn(out, F.when(_not_after(h, i, F.col("_th1"), F.col("_ti1")), "test")
                         .when(_not_after(h, i, F.col("_th2"), F.col("_ti2")), "val").otherwise("train"))
            .drop("_lab", "_th1", "_ti1", "_th2", "_ti2", HASH_COL))


def split_sizes(df: DataFrame, split_col: str = "split") -> DataFrame:
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_rows"))


def label_table(df: DataFrame, label: str = "label", order: str = "alphabet",
                id_col: str | None = None) -> DataFrame:
    """(label, label_idx) — contiguous 0-based class index.

    ``order='alphabet'``: sorted labels; ``'first_seen'``: by the smallest id
    of each class (the reference numbers classes in order of appearance).
    One row per class; the window runs over that class table.
    """
    if order == "first_seen":
        if id_col is None:
            raise ValueError("first_seen order needs id_col")
        t = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.min(id_col).alias("_first"))
        w = Window.orderBy("_first", label)
    else:
        t = df.where(F.col(label).isNotNull()).select(label).distinct()
        w = Window.orderBy(label)
    return t.withColumn("label_idx", (F.row_number().over(w) - 1).cast("bigint")).select(label, "label_idx")


def label_encode(df: DataFrame, labels: DataFrame, label: str = "label",
                 out: str = "label_idx") -> DataFrame:
    """Map label → index by joining the class table (broadcast: one row per class)."""
    t = labels.select(F.col(label).alias("_lab"), F.col("label_idx").alias(out))
    t, _ = small_table(t)
    return df.join(t, F.col(label) == F.col("_lab"), "left").drop("_lab")


def label_decode(df: DataFrame, labels: DataFrame, idx_col: str = "prediction",
                 out: str = "predicted_label", label: str = "label") -> DataFrame:
    t = labels.select(F.col(label).alias(out), F.col("label_idx").alias("_idx"))
    t, _ = small_table(t)
    return (df.join(t, F.col(idx_col).cast("bigint") == F.col("_idx"), "left")
            .drop("_idx"))


def predefined_fold(split_col: str = "split") -> Column:
    """−1 for rows always in the fit (train), 0 for the validation fold."""
    return (F.when(F.col(split_col) == "train", F.lit(-1))
            .when(F.col(split_col) == "val", F.lit(0)).cast("bigint"))


def refit_set(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Train + validation rows (the final fit after model selection)."""
    return df.where(F.col(split_col).isin("train", "val"))


def balance_deficits(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, class_n, deficit): synthetic rows needed to reach the largest class."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).cast("bigint").alias("class_n"))
    return (c.withColumn("deficit", (F.max("class_n").over(Window.partitionBy(F.lit(0)))
                                     - F.col("class_n")).cast("bigint")))
