"""SMOTE class balancing: interpolate between a row and one of its k nearest
same-class neighbours until every class is as large as the largest.

Deterministic variant of the usual random draws, so a re-run (or a
recomputed partition after a lost executor) gives the same rows:

* class c needs ``deficit_c = max_n − n_c`` rows, numbered s = 0 … deficit−1;
* synthetic row s uses the base row whose seeded class rank is ``s mod n_c``
  (bases spread evenly over the class);
* ``h = md5(label ‖ '-' ‖ s ‖ '-' ‖ seed)``; neighbour rank
  ``1 + int(h[0:8], 16) mod k``, and gap
  ``int(h[8:16], 16) / 2³²`` ∈ [0, 1);
* value = base + gap · (neighbour − base), element-wise.

A class with too few rows for k neighbours fails (``small_class="raise"``), or
uses the ``n_c − 1`` it has (``"shrink"``), its only row being copied.
Neighbours are computed only for the base rows actually used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penmark.operators.dataset import balance_deficits, stratified_rank
from penmark.operators.joins import small_table
from penmark.operators.neighbours import knn_within_class

# Synthetic rows generated by one exploded chunk (spreads a small class with a
# large deficit over many tasks instead of one).
CHUNK_ROWS = 100_000


def _hex_int(h: Column, start: int) -> Column:
    return F.conv(F.substring(h, start, 8), 16, 10).cast("bigint")


def _bases(df: DataFrame, id_col: str, label: str, seed: int) -> DataFrame:
    """Rows used as bases (seeded class rank below the class's deficit), with
    ``class_rank``, ``class_n`` and ``deficit``; other columns are kept."""
    ranked = stratified_rank(df, label, id_col, seed)
    deficits, _ = small_table(balance_deficits(df.select(label), label)
                              .select(F.col(label).alias("_lab"), "deficit"))
    return (ranked.join(deficits, F.col(label).eqNullSafe(F.col("_lab"))).drop("_lab")
            .where(F.col("class_rank") < F.col("deficit")))


def _explode_synthetic(bases: DataFrame, id_col: str, label: str, k: int, seed: int,
                       chunk_rows: int, small_class: str) -> DataFrame:
    """One row per synthetic row to make: the base row's columns plus ``s``,
    ``k_c``, ``nb_rank`` and ``gap``.

    Base r of a class makes s = r, r + n_c, r + 2·n_c, … < deficit.  Those are
    cut into chunks of ``chunk_rows`` first and the chunks repartitioned, so a
    base with a huge share (tiny class, large deficit) is spread over tasks.
    """
    step = F.col("class_n") * F.lit(chunk_rows)
    chunks = (bases.withColumn("_start", F.explode(F.sequence(F.col("class_rank"), F.col("deficit") - 1, step)))
              .repartition(F.col(id_col), F.col("_start")))
    last = F.least(F.col("_start") + F.col("class_n") * F.lit(chunk_rows - 1), F.col("deficit") - 1)
    syn = chunks.withColumn("s", F.explode(F.sequence(F.col("_start"), last, F.col("class_n")))).drop("_start")
    h = F.md5(F.concat_ws("-", F.col(label).cast("string"), F.col("s").cast("string"), F.lit(str(seed))))
    k_c = F.least(F.lit(k), F.col("class_n") - 1)
    if small_class == "raise":
        msg = F.concat(F.lit("class "), F.col(label).cast("string"), F.lit(f" has too few rows for {k} neighbours: "),
                       F.col("class_n").cast("string"))
        k_c = F.when(F.col("class_n") <= k, F.raise_error(msg).cast("bigint")).otherwise(F.lit(k))
    return (syn.withColumn("_h", h).withColumn("k_c", k_c.cast("bigint"))
            .withColumn("nb_rank", F.when(F.col("k_c") > 0, F.pmod(_hex_int(F.col("_h"), 1), F.col("k_c")) + 1)
                        .cast("bigint"))
            .withColumn("gap", _hex_int(F.col("_h"), 9) / F.lit(4294967296.0))
            .withColumn("s", F.col("s").cast("bigint")).drop("_h"))


def smote_oversample(df: DataFrame, id_col: str, label: str, vec_col: str, k: int = 5,
                     seed: int = 42, block_rows: int = 2048,
                     chunk_rows: int = CHUNK_ROWS, small_class: str = "raise") -> DataFrame:
    """Original rows plus synthetic ones.

    Columns: ``row_key`` (original id as text, or ``syn-<label>-<s>``),
    ``label``, ``vec`` (array<double>), ``is_synthetic``, ``base_id``,
    ``nb_id``, ``gap`` (NULL for original rows).

    Each base row is first given its own vector and its k neighbours (id and
    vector, k ≤ 5, so the row stays small); the synthetic rows are exploded
    from it last and pick their neighbour by rank from that array.  No join
    runs after the explode, so a base used by many synthetic rows is never a
    hot join key and synthetic rows are never shuffled.
    """
    if small_class not in ("raise", "shrink"):
        raise ValueError(f"unknown small_class {small_class!r}")
    rows = df.select(F.col(id_col).alias("_id"), F.col(label).alias("_label"),
                     F.col(vec_col).cast("array<double>").alias("_vec"))
    bases = _bases(rows, "_id", "_label", seed)
    nn = knn_within_class(rows, "_id", "_label", "_vec", k, queries=bases.select("_id", "_label", "_vec"),
                          block_rows=block_rows, with_vectors=True)
    nbs = (nn.groupBy(F.col("q_id").alias("_id"))
           .agg(F.array_sort(F.collect_list(F.struct("rank", F.col("c_id").alias("id"),
                                                     F.col("c_vec").alias("vec")))).alias("_nbs")))
    with_nbs = bases.join(nbs, "_id", "left")            # ≤ k neighbours per base row
    syn = _explode_synthetic(with_nbs, "_id", "_label", k, seed, chunk_rows, small_class)
    nb = F.when(F.col("nb_rank").isNotNull(), F.try_element_at("_nbs", F.col("nb_rank").cast("int")))
    syn = (syn.withColumn("_nb", nb)
           .withColumn("nb_id", F.coalesce(F.col("_nb.id"), F.col("_id")))        # no neighbour: copy
           .withColumn("_nvec", F.coalesce(F.col("_nb.vec"), F.col("_vec")))
           .select(F.concat_ws("-", F.lit("syn"), F.col("_label").cast("string"),
                               F.col("s").cast("string")).alias("row_key"),
                   F.col("_label").alias("label"),
                   F.zip_with("_vec", "_nvec", lambda x, y: x + F.col("gap") * (y - x)).alias("vec"),
                   F.lit(True).alias("is_synthetic"), F.col("_id").alias("base_id"), "nb_id",
                   F.when(F.col("k_c") > 0, F.col("gap")).otherwise(F.lit(0.0)).alias("gap")))
    orig = rows.select(F.col("_id").cast("string").alias("row_key"), F.col("_label").alias("label"),
                       F.col("_vec").alias("vec"), F.lit(False).alias("is_synthetic"),
                       F.lit(None).cast(syn.schema["base_id"].dataType).alias("base_id"),
                       F.lit(None).cast(syn.schema["nb_id"].dataType).alias("nb_id"),
                       F.lit(None).cast("double").alias("gap"))
    return orig.unionByName(syn)
