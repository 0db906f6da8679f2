"""Epoch training that is stopped and goes on, batched scoring, keyed streams."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from penmark.operators import batched as B
from penmark.operators import epochs as E
from penmark.operators import passes as P
from penmark.plans.jobs import train_job
from penmark.sources.artifacts import save_version
from penmark.sources.fixtures import recipes_d, table
from penmark.streaming.score import KeyedScorer, start_keyed_score
from tests.conftest import SF_MID, SF_SMALL


@pytest.fixture(scope="module")
def docs(spark):
    d = table(spark, SF_MID, "documents").select("doc_id", "text", F.col("lang").alias("label"))
    return d.where("doc_id % 4 <> 0"), d.where("doc_id % 4 = 0")


def test_stopped_run_goes_on_as_if_it_had_not(spark, tmp_dir, docs):
    train, val = docs
    kw = dict(epochs=4, batch=32, warm_up=20, rate=0.05, patience=4)
    whole = E.fit_epochs(train, val, "doc_id", f"{tmp_dir}/whole", **kw)
    E.fit_epochs(train, val, "doc_id", f"{tmp_dir}/parts", stop_after=1, **kw)
    E.fit_epochs(train, val, "doc_id", f"{tmp_dir}/parts", stop_after=2, **kw)
    parts = E.fit_epochs(train, val, "doc_id", f"{tmp_dir}/parts", **kw)
    assert np.array_equal(whole.weights, parts.weights) and whole.val_losses == parts.val_losses and len(parts.train_losses) == 4
    assert whole.val_losses[whole.best_epoch - 1] == min(whole.val_losses)
    got = E.score_epochs(whole, val, "doc_id").join(val, F.col("row_key") == F.col("doc_id").cast("string"))
    top = val.groupBy("label").count().agg(F.max("count") / F.sum("count")).first()[0]
    assert got.select(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0] > top + 0.1


def test_best_epoch_is_kept_when_the_loss_rises(spark, tmp_dir, docs, monkeypatch):
    train, val = docs
    losses = iter([3.0, 2.0, 2.5, 2.6, 1.0])
    monkeypatch.setattr(E, "validation_loss", lambda *a: next(losses))
    m = E.fit_epochs(train.limit(50), val.limit(5), "doc_id", f"{tmp_dir}/s", epochs=5, patience=2)
    assert m.best_epoch == 2 and m.val_losses == [3.0, 2.0, 2.5, 2.6]


def test_schedule():
    s = E.Schedule(10, 110)
    assert [s(1), s(10), s(60), s(110), s(200)] == [0.1, 1.0, 0.5, 0.0, 0.0]


def test_gradient_of_the_text_kernel():
    k = E.LinearText(5, 3, 0.1)
    rng = np.random.default_rng(0)
    block = {"bucket_size": np.array([2, 0, 3]), "bucket": np.array([0, 4, 1, 2, 4]), "weight": rng.random(5), "label_idx": np.array([0, 2, 1])}
    p, rows = rng.normal(size=18), np.array([2, 0, 1])
    _, g = k.gradient(p, block, rows)
    for i in range(18):
        d = np.zeros(18)
        d[i] = 1e-6
        assert abs((k.gradient(p + d, block, rows)[0] - k.gradient(p - d, block, rows)[0]) / 2e-6 - g[i]) < 1e-6


def test_length_batches_are_bounded():
    sizes = [0, 1, 900, 3, 3, 17, 20, 5000, 31, 2, 16, 900]
    got = B.length_batches(sizes, 1000)
    assert sorted(i for b in got for i in b) == list(range(len(sizes)))
    for b in got:
        wide = max(1, max(sizes[i] for i in b))
        assert len(b) == 1 or (len(b) * wide <= 1000 and wide <= 2 * max(1, min(sizes[i] for i in b)))


def test_batched_equals_row_by_row(spark, monkeypatch):
    def predict(state, ids, mask):
        z = (ids * mask).sum(1) % 7
        return np.stack([z, mask.sum(1) + 1.0], 1) / (z + mask.sum(1) + 1.0)[:, None]
    model = B.RecordModel(lambda: "m", lambda s, t: [ord(c) for c in t], predict)
    monkeypatch.setattr(B, "WINDOW_ROWS", 37)
    d = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    d = d.unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-3, "x" * 70000)], "doc_id long, text string"))
    got = {r["doc_id"]: r["probabilities"] for r in B.score_records(d, "text", model, max_tokens=5000).collect()}
    rows = d.collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r["doc_id"]] == B.predict_texts(model, "m", [r["text"]], 5000)[0].tolist()
    assert B.score_records(d.limit(0), "text", model).count() == 0


def test_replayed_batch_and_new_model(spark, tmp_dir):
    d = recipes_d(spark, SF_SMALL)
    art = train_job(d, mlp_params={"hidden": (4,), "max_iter": 5}).artifacts
    root, src, out = (f"{tmp_dir}/{x}" for x in ("models", "in", "out"))
    save_version(spark, art, root)
    rows = d.drop("label")
    rows.where("recipe_id % 2 = 0").coalesce(1).write.parquet(src)
    start_keyed_score(spark, src, rows.schema, root, out, f"{tmp_dir}/ckpt").awaitTermination()
    first = sorted(map(tuple, spark.read.parquet(out).collect()))
    KeyedScorer(root, out)(spark.read.parquet(src), 0)                       # the batch again
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == first
    save_version(spark, art, root)
    rows.where("recipe_id % 2 = 1").coalesce(1).write.mode("append").parquet(src)
    start_keyed_score(spark, src, rows.schema, root, out, f"{tmp_dir}/ckpt").awaitTermination()
    got = {r["batch"]: (r["m"], r["n"]) for r in spark.read.parquet(out).groupBy("batch").agg(F.max("model").alias("m"), F.count("*").alias("n")).collect()}
    n = rows.count()
    assert got == {0: ("v1", -(-n // 2)), 1: ("v2", n // 2)}


def test_blocks_lie_in_files_of_their_own_and_go_one_by_one(spark, monkeypatch):
    """A task reads the blocks of its share, not whatever a file was given, one at a time."""
    import pyarrow as pa
    from pyspark.sql import functions as F
    from penmark.operators import passes
    monkeypatch.setattr(passes, "SHARD_BYTES", 16 << 10)
    rows = spark.range(6000).select(F.col("id").alias("row_key"), F.array(F.rand(1), F.rand(2)).alias("features"), F.lit(1.0).alias("label_idx"))
    blocks, shards = passes.packed(rows, "row_key", ["features", "label_idx"], 24)
    files = blocks.select(F.input_file_name().alias("f")).groupBy("f").count().collect()
    assert shards > 4 and len(files) == blocks.count() and {r["count"] for r in files} == {1}

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])
    with passes.block_batches(spark):
        found = blocks.coalesce(1).mapInArrow(sizes, "n long").collect()
    assert {r["n"] for r in found} == {1}


class WhereTrained:
    """Kernel whose moments show in which tasks its steps were made."""
    rate, cost = 0.1, 1.0

    def start(self):
        return np.zeros(512)

    def gradient(self, p, block, rows):
        from pyspark import TaskContext
        g = np.zeros(512)
        g[TaskContext.get().partitionId()] = 1.0
        return 0.0, g


def test_every_group_of_models_meets_every_shard_in_a_task_of_its_own(spark, monkeypatch):
    assert P.task_groups(72, 2, 12) == 6 and P.task_groups(72, 3, 8) == 8 and P.task_groups(1, 13, 12) == 1
    assert P.task_groups(72, 13, 12) == 4 and P.task_groups(2, 1, 8) == 2
    rows = spark.range(900).select(F.col("id").alias("k"), F.col("id").cast("double").alias("x"))
    monkeypatch.setattr(P, "SHARD_BYTES", 2400)
    blocks, shards = P.packed(rows, "k", ["x"], 8)
    assert shards == 3 and spark.sparkContext.defaultParallelism == 4
    kernels = [WhereTrained() for _ in range(8)]
    states = [P.fresh(k) for k in kernels]
    P.one_pass(blocks, shards, kernels, states, 1, P.Adam(), 1)
    tasks = [frozenset(np.flatnonzero(s.m)) for s in states]
    assert all(len(t) == 3 for t in tasks) and len(set(tasks)) == 4 and len(frozenset().union(*tasks)) == 12
