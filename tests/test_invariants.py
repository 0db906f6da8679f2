"""Invariants of splitting, balancing, kNN and the jobs (sf0.001 / sf0.01)."""

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SF_MID, SF_SMALL
from penmark.operators import dataset as D
from penmark.operators.neighbours import knn_within_class
from penmark.operators.smote import smote_oversample
from penmark.plans import jobs as J
from penmark.sources.fixtures import recipes_d, table


def test_split_disjoint_cover_and_sizes(spark):
    d = recipes_d(spark, SF_MID)
    s = D.stratified_split(d).cache()
    assert s.count() == d.count() == s.select("recipe_id").distinct().count()
    sizes = {r["split"]: r["n_rows"] for r in D.split_sizes(s).collect()}
    n = sum(sizes.values())
    assert sizes["test"] == int(np.ceil(n * 0.2))
    per = s.groupBy("label").pivot("split", ["train", "val", "test"]).count().collect()
    for r in per:                              # every class is in every split
        assert r["train"] > r["val"] > 0 and r["test"] > 0


def test_bucketed_rank_equals_window_rank(spark):
    from pyspark.sql.window import Window
    d = recipes_d(spark, SF_MID)
    ours = D.stratified_rank(d, bucket_digits=2).select("recipe_id", "class_rank")
    w = Window.partitionBy("label").orderBy(D.hash_key("recipe_id"), "recipe_id")
    ref = d.select("recipe_id", (F.row_number().over(w) - 1).alias("ref"))
    assert ours.join(ref, "recipe_id").where("class_rank <> ref").count() == 0


def test_knn_matches_brute_force(spark):
    e = table(spark, SF_SMALL, "embeddings")
    got = knn_within_class(e, "vec_id", "label", "embedding", k=3, block_rows=64)  # several blocks per class
    pdf = e.toPandas()
    vec = np.stack(pdf["embedding"].to_numpy()).astype(np.float64)
    ids, labs = pdf["vec_id"].to_numpy(), pdf["label"].to_numpy()
    want = set()
    for i in range(len(ids)):
        m = (labs == labs[i]) & (ids != ids[i])
        d2 = ((vec[m] - vec[i]) ** 2).sum(1)
        order = np.lexsort((ids[m], d2))[:3]
        want |= {(int(ids[i]), r + 1, int(ids[m][j])) for r, j in enumerate(order)}
    assert {(r["q_id"], r["rank"], r["c_id"]) for r in got.collect()} == want


def test_smote_balances_and_interpolates(spark):
    e = table(spark, SF_SMALL, "embeddings")
    out = smote_oversample(e, "vec_id", "label", "embedding", k=5).cache()
    sizes = [r["count"] for r in out.groupBy("label").count().collect()]
    assert len(set(sizes)) == 1
    syn = out.where("is_synthetic").toPandas()
    vecs = {int(r["vec_id"]): np.asarray(r["embedding"], dtype=float) for r in e.collect()}
    for _, r in syn.iterrows():
        b, n, g = vecs[int(r["base_id"])], vecs[int(r["nb_id"])], r["gap"]
        assert 0.0 <= g < 1.0
        assert np.allclose(np.asarray(r["vec"]), b + g * (n - b), atol=1e-9)


def test_train_save_load_predict_roundtrip(spark, tmp_dir):
    d = recipes_d(spark, SF_MID)
    res = J.train_job(d, artifacts_path=tmp_dir + "/art", mlp_params={"hidden": (16,), "max_iter": 60})
    rep = {r["cls"]: r for r in res.report.collect()}
    assert rep["accuracy"]["f1"] > 0.5
    assert abs(rep["weighted avg"]["recall"] - rep["accuracy"]["f1"]) < 1e-9
    cm = res.confusion.collect()
    assert sum(sum(v for k, v in r.asDict().items() if k.startswith("pred_")) for r in cm) \
        == rep["accuracy"]["support"]
    before = J.predict_job(d, res.artifacts).withColumnRenamed("prediction", "a")
    after = J.predict_job(d.drop("label"), tmp_dir + "/art").withColumnRenamed("prediction", "b")
    j = before.join(after, "recipe_id")
    assert j.count() == d.count() and j.where("a <> b").count() == 0


def test_smote_hot_base_rows_chunked(spark):
    """A small class with a large deficit: every base row makes many synthetic
    rows, cut into several chunks.  Rows must follow the deterministic rule
    (base = rank s mod n_c, neighbour and gap from md5) whatever the chunking."""
    import hashlib
    d = recipes_d(spark, SF_SMALL).select(
        "recipe_id", "label",
        F.array(F.length("description").cast("double"), F.size("steps").cast("double"),
                (F.col("recipe_id") % 7).cast("double")).alias("v"))
    a = smote_oversample(d, "recipe_id", "label", "v", k=3, chunk_rows=4).cache()
    b = smote_oversample(d, "recipe_id", "label", "v", k=3).cache()
    sizes = {r["label"]: r["count"] for r in a.groupBy("label").count().collect()}
    assert len(set(sizes.values())) == 1
    cols = ["row_key", "label", "vec", "base_id", "nb_id", "gap"]
    assert a.select(*cols).exceptAll(b.select(*cols)).count() == 0 and a.count() == b.count()
    # base row of synthetic row s is the row of seeded class rank s mod n_c
    rank = D.stratified_rank(d, "label", "recipe_id").select("recipe_id", "class_rank", "class_n")
    syn = a.where("is_synthetic").withColumn("s", F.element_at(F.split("row_key", "-"), -1).cast("long"))
    j = syn.join(rank, syn.base_id == rank.recipe_id)
    assert j.where(F.col("s") % F.col("class_n") != F.col("class_rank")).count() == 0
    r = syn.where("gap > 0").first()
    h = hashlib.md5(f"{r['label']}-{r['s']}-42".encode()).hexdigest()
    assert abs(r["gap"] - int(h[8:16], 16) / 2 ** 32) < 1e-12


def test_text_models_bayes_and_logistic(spark):
    """Both stage-1 models fit, give one probability per class summing to 1,
    and beat always answering the majority class by a wide margin."""
    from penmark.functions.features import add_text_column
    from penmark.operators import models as ML
    d = D.stratified_split(add_text_column(recipes_d(spark, SF_MID)))
    test = d.where("split = 'test'")
    majority = test.groupBy("label").count().agg(F.max("count")).first()[0] / test.count()
    for model in ("bayes", "logistic"):
        m = ML.text_classifier_fit(d.where("split = 'train'"), model=model)
        s = ML.text_classifier_score(m, d.where("split = 'test'"), keep=["label"])
        pc = ML.prob_columns(m)
        assert len(pc) == 4
        labels = ML.model_labels(m)
        pred = F.element_at(F.array(*[F.lit(x) for x in labels]),
                            F.array_position(F.array(*pc), F.array_max(F.array(*pc))).cast("int"))
        row = s.select(F.avg((pred == F.col("label")).cast("double")).alias("acc"),
                       F.max(F.abs(sum((F.col(c) for c in pc), F.lit(0.0)) - 1.0)).alias("err")).first()
        assert row["acc"] > majority + 0.2 and row["err"] < 1e-9, (model, majority, row)


def _split_brute(rows, test_size, val_size, seed=42):
    """Reference rule in plain Python: rank each class by (md5(id-seed), id),
    size the parts by largest remainder (ties: smaller label, NULL first)."""
    import hashlib
    import math

    def alloc(counts, frac):
        n = sum(counts.values())
        keep = n - math.ceil(n * frac)
        base = {c: counts[c] * keep // n for c in counts}
        rem = {c: counts[c] * keep - base[c] * n for c in counts}
        need = keep - sum(base.values())
        order = sorted(counts, key=lambda c: (-rem[c], c is not None, c or ""))
        return {c: base[c] + (1 if i < need else 0) for i, c in enumerate(order)}

    counts = {}
    for _, lab in rows:
        counts[lab] = counts.get(lab, 0) + 1
    keep1 = alloc(counts, test_size)
    n_test = {c: counts[c] - keep1[c] for c in counts}
    n_val = ({c: keep1[c] - alloc(keep1, val_size)[c] for c in counts} if val_size > 0
             else {c: 0 for c in counts})
    out = {}
    for c in counts:
        ids = sorted((i for i, lab in rows if lab == c),
                     key=lambda i: (hashlib.md5(f"{i}-{seed}".encode()).hexdigest(), i))
        for r, i in enumerate(ids):
            out[i] = "test" if r < n_test[c] else "val" if r < n_test[c] + n_val[c] else "train"
    return out


def test_split_thresholds_edge_classes(spark):
    """Classes of 1 and 2 rows (empty test/val parts), a NULL label, a large
    class: the broadcast-threshold split equals the brute-force rule, for
    the three-way and the two-way split."""
    labs = ["a"] + ["b"] * 2 + [None] * 3 + ["c"] * 50 + ["d"] * 7
    ids = table(spark, SF_SMALL, "orders").select("o_orderkey").orderBy("o_orderkey") \
        .limit(len(labs)).collect()
    rows = [(r["o_orderkey"], lab) for r, lab in zip(ids, labs)]
    df = spark.createDataFrame(rows, "recipe_id long, label string")
    for test_size, val_size in ((0.2, 0.2), (0.2, 0.0), (0.5, 0.5)):
        got = {r["recipe_id"]: r["split"] for r in
               D.stratified_split(df, test_size=test_size, val_size=val_size).collect()}
        assert got == _split_brute(rows, test_size, val_size), (test_size, val_size)
