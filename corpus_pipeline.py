"""Training-data pipeline over ``documents``: drop toxic texts, keep one of each
near-duplicate group, cut repeated substrings, drop benchmark leaks, pack.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of
``docs``.  Stages treat nulls as their operators say: a null or empty text is
never toxic, linked or contaminated and stays.  The near-duplicate stage judges
each row by its own text, whatever its id: of a group the row with the smallest
id stays (rows without an id last), and wordless rows that repeat an id and a
text are reduced to one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from penmark.llm import chunkdedup, decontam, minhash, packing, toxicity
from penmark.llm.common import numbered, read, row_key
from penmark.llm.queries import tokenizer_paths, toxicity_model
from penmark.session import cut_lineage, ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    score = toxicity.score_udf(docs, toxicity_model(spark, sf_dir))
    return (docs.withColumn("__pm_toxic", score(F.col("text"))["score"])
            .where(F.col("__pm_toxic") < toxicity.THRESHOLD).drop("__pm_toxic"))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    rows = numbered(docs, *docs.columns, name="judged")
    found = (minhash.groups(rows.select(F.col("__pm_row").alias("doc_id"), "text"))
             .select(F.col("doc_id").alias("__pm_row"), "n_shingles", "component_id"))
    # a group is a component; a wordless row's is its id and text, or itself without an id
    wordless = F.col("n_shingles") == 0
    named = rows.select("__pm_row", "doc_id", row_key()[1]).join(found, "__pm_row")
    kept = (named.groupBy(F.when(~wordless, F.col("component_id")).alias("__pm_c"),
                          F.when(wordless, F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("\x00"), "__pm_row"))).alias("__pm_id"),
                          F.when(wordless, F.col("__pm_h")).alias("__pm_t"))
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__pm_h", "__pm_row")).alias("__pm_first"))
            .select("__pm_first.__pm_row"))
    return rows.join(kept, "__pm_row", "left_semi").select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    out = chunkdedup.dedup(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__pm_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    found = decontam.find(docs.select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    keys = found.select("__pm_id", "__pm_h").distinct()
    return (docs.select("*", *row_key()).join(keys, ["__pm_id", "__pm_h"], "left_anti").select(*docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pack(packing.pieces(docs, *tokenizer_paths()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic), ("near_duplicates", keep_one_of_each_group), ("repeated_substrings", cut_repeats),
    ("decontamination", drop_leaks), ("packing", pack)]

#: Trained scores, hashed chunks and tokens have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut_lineage(docs, name)
    return docs
