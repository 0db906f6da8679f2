"""Jobs of many passes: documents dealt out once, folds' models shipped to their own rows."""

import pytest
from pyspark.sql import functions as F

from penmark.operators import models as ML
from penmark.operators import textmodel as X
from penmark.plans import q_models as Q
from penmark.sources import fixtures as FX


def texts(spark, n=300):
    words = ["Alpha", "beta", "Straße", "été", "ωμέγα", "x_1", "½", "gamma"]
    rows = [(i, ["de", "en", "fr"][i % 3], None if i % 50 == 7 else " ".join(words[(i * k) % (3 + i % 6)] for k in range(i % 17)))
            for i in range(n)]
    return spark.createDataFrame(rows, "recipe_id long, label string, text string")


def test_folds_models_are_shipped_to_their_own_rows(spark, monkeypatch):
    df = texts(spark)

    def scores():
        s = ML.out_of_fold_scores(df, "text", "label", "recipe_id", folds=3)
        return {r["recipe_id"]: tuple(r[c] for c in s.columns if c.startswith("prob_")) for r in s.collect()}
    together = scores()
    f = df.withColumn("_fold", F.pmod(F.xxhash64("recipe_id"), F.lit(3)).cast("int"))
    model = X.fit(f, "text", "label", "_fold")
    assert model.entries < 3 * model.pairs
    monkeypatch.setattr(X, "MAX_ENTRIES", model.entries)
    with monkeypatch.context() as m:
        m.setattr(X, "joined", lambda *a: pytest.fail("joined by bucket"))
        assert scores() == together and len(together) == 300
    monkeypatch.setattr(X, "MAX_ENTRIES", 0)
    joined = scores()
    assert joined.keys() == together.keys()
    assert all(abs(a - b) < 1e-9 for k in joined for a, b in zip(joined[k], together[k]))


def test_rows_of_no_fold_are_kept(spark, monkeypatch):
    df = texts(spark, 60).withColumn("_fold", F.when(F.col("recipe_id") % 4 > 0, F.col("recipe_id") % 4 - 1).cast("int"))
    model = X.fit(df.where("_fold IS NOT NULL"), "text", "label", "_fold")
    monkeypatch.setattr(X, "MAX_ENTRIES", model.entries)
    assert X.score(model, df, "text", "_prob", "_fold").count() == 60


def test_tokens_cut_as_bytes_are_the_same_tokens():
    for t in ["µ ß É Ÿ x_1 ½", "K Ω é", "İx", "a\x85k\xa0k\x1ck", "", "ÿ×é÷ß", "ª²k _ __a_"]:
        assert [X.spelt(w) for w in X.cut(t)] == X.TOKEN.findall(t.lower())
    at = X.Buckets(1 << 18)
    assert at["é".encode("latin-1")] == at["é"]


def test_a_job_deals_one_row_group_out_once(spark, tmp_dir, monkeypatch):
    rows = [(i % 390, f"text {i}\nline {i % 7}" if i % 31 else None, ["de", "en"][i % 2] if i % 13 else None, f"src{i % 5}") for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(f"{tmp_dir}/documents.parquet")
    monkeypatch.setattr(FX, "KEPT_ROWS", 100)
    sizes = [r["count"] for r in Q._docs(spark, tmp_dir).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 400 and sum(sizes) == 400
    kept = FX.recipes_d(spark, tmp_dir, keep=True)
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
    assert kept.exceptAll(FX.recipes_d(spark, tmp_dir)).count() == 0 and kept.count() == 400
