"""Network gradients, shared passes, text counts and mergeable metrics."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from penmark.functions.features import add_text_column
from penmark.operators import models as ML
from penmark.operators import network as N
from penmark.operators import passes as P
from penmark.operators import textmodel as X
from penmark.operators.metrics import Accuracy, MacroF1, Metric, accuracy, classification_report, evaluate, measure
from penmark.sources.fixtures import recipes_d
from tests.conftest import SF_MID, SF_SMALL


@pytest.mark.parametrize("activation", ["relu", "tanh"])
@pytest.mark.parametrize("hidden", [(7,), (6, 5)])
def test_gradients_against_finite_differences(activation, hidden):
    rng = np.random.default_rng(1)
    sizes = (4, *hidden, 3)
    p = N.NetworkKernel(sizes, activation, 0.1, 0.01, 3).start() + rng.normal(0, 0.1, sum(a * b + b for a, b in zip(sizes, sizes[1:])))
    x, y = rng.normal(size=(11, 4)), rng.integers(0, 3, 11)
    _, grad = N.loss_gradient(p, sizes, activation, 0.1, x, y)
    for i in rng.choice(len(p), 25, replace=False):
        d = np.zeros_like(p)
        d[i] = 1e-6
        slope = (N.loss_gradient(p + d, sizes, activation, 0.1, x, y)[0] - N.loss_gradient(p - d, sizes, activation, 0.1, x, y)[0]) / 2e-6
        assert abs(slope - grad[i]) < 1e-6


def ring(spark, n, seed=0):
    """Two classes that no straight line parts."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2))
    y = (np.hypot(*x.T) > 1.1).astype(float)
    return spark.createDataFrame([(f"r{i}", float(b), [float(v) for v in a]) for i, (a, b) in enumerate(zip(x, y))],
                                 "row_key string, label_idx double, features array<double>"), x, y


def test_networks_train_together_as_alone(spark):
    rows, x, y = ring(spark, 600)
    grid = [ML.combination((16,), "relu", 1e-3, 0.01, 120), ML.combination((8, 4), "tanh", 1e-4, 0.01, 120)]
    both = N.fit_networks(rows, 2, 2, grid)
    for g, net in zip(grid, both):
        assert (net.probabilities(x).argmax(1) == y).mean() > 0.93
        alone = N.fit_networks(rows, 2, 2, [g])[0]
        assert np.array_equal(alone.flat, net.flat)


def test_many_shards_are_averaged(spark, monkeypatch):
    rows, x, y = ring(spark, 1500)
    monkeypatch.setattr(P, "SHARD_BYTES", 24 * 100)
    monkeypatch.setattr(P, "FOLD", 4)
    net = N.fit_networks(rows, 2, 2, [ML.combination((16,), "relu", 1e-4, 0.02, 60)])[0]
    assert (net.probabilities(x).argmax(1) == y).mean() > 0.93
    again = N.fit_networks(rows.repartition(7), 2, 2, [ML.combination((16,), "relu", 1e-4, 0.02, 60)])[0]
    assert np.allclose(net.flat, again.flat, atol=1e-6)        # whatever the partitions


def test_grid_refits_the_best_by_a_caller_s_metric(spark):
    class Second(Metric):
        """Share of class "1" found: a caller's own."""
        name = "second"

        def start(self):
            return [0, 0]

        def update(self, s, actual, predicted):
            return [s[0] + sum(a == p == "1" for a, p in zip(actual, predicted)), s[1] + sum(a == "1" for a in actual)]

        def merge(self, a, b):
            return [a[0] + b[0], a[1] + b[1]]

        def finish(self, s):
            return s[0] / max(1, s[1])

    rows, _, _ = ring(spark, 500)
    df = rows.select("row_key", "label_idx", F.col("features")[0].alias("a"), F.col("features")[1].alias("b"),
                     F.col("label_idx").cast("int").cast("string").alias("label"),
                     F.when(F.abs(F.xxhash64("row_key")) % 5 == 0, "val").otherwise("train").alias("split"))
    grid = ML.param_grid([(2,), (12,)], [1e-3], [0.02], ["relu", "tanh"], max_iter=60)
    net, board = ML.grid_search(df, ["a", "b"], ["0", "1"], "row_key", grid=grid, metric=Second())
    got = board.collect()
    assert [r["hidden"] for r in got] == ["(2,)", "(2,)", "(12,)", "(12,)"] and all(0 <= r["val_second"] <= 1 for r in got)
    best = grid[max(range(4), key=lambda i: (got[i]["val_second"], -i))]
    want = ML.mlp_fit(df, ["a", "b"], 2, "row_key", **best)
    assert net.sizes == want.sizes and np.array_equal(net.flat, want.flat)


def test_metrics_as_mergeable_aggregates(spark):
    rows = [("a", "a", 1)] * 30 + [("a", "b", 1)] * 5 + [("b", "b", 2)] * 9 + [("b", None, 2)] + [("c", "a", None)] * 2 + [(None, "a", 1)]
    df = spark.createDataFrame(rows, "label string, prediction string, g int").repartition(5)
    rep = {r["cls"]: r["f1"] for r in classification_report(df).collect()}
    assert abs(measure(df, Accuracy()).first()["value"] - accuracy(df).first()["accuracy"]) < 1e-12
    assert abs(measure(df, MacroF1()).first()["value"] - rep["macro avg"]) < 1e-12
    by = {r["g"]: r["value"] for r in measure(df, Accuracy(), by=["g"]).collect()}
    assert by == {1: 30 / 35, 2: 0.9, None: 0.0}
    assert measure(df.limit(0), MacroF1()).first()["value"] == 0.0
    out = evaluate(df, ["a", "b", "c"], split_col=None, metrics=[MacroF1()])
    assert abs(out["f1"].first()["value"] - rep["macro avg"]) < 1e-12


def probs(df):
    return {r["recipe_id"]: [r[c] for c in sorted(r.asDict()) if c.startswith("prob_")] for r in df.collect()}


def test_out_of_fold_equals_separate_fits(spark):
    d = add_text_column(recipes_d(spark, SF_SMALL)).select("recipe_id", "label", "text")
    got = probs(ML.out_of_fold_scores(d, "text", "label", "recipe_id", folds=3))
    f = d.withColumn("f", F.pmod(F.xxhash64("recipe_id"), F.lit(3)))
    want = {}
    for i in range(3):
        m = ML.text_classifier_fit(f.where(F.col("f") != i))
        want |= probs(ML.text_classifier_score(m, f.where(F.col("f") == i), keep=["recipe_id"]))
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k], atol=1e-12) for k in got)


def test_scores_by_join_equal_shipped_scores(spark, monkeypatch):
    d = add_text_column(recipes_d(spark, SF_SMALL)).select("recipe_id", "label", "text")
    d = d.unionByName(spark.createDataFrame([(-1, None, None), (-2, "en", ""), (-3, "en", "· ·")], "recipe_id long, label string, text string"))
    here = probs(ML.out_of_fold_scores(d, "text", "label", "recipe_id"))
    m = ML.text_classifier_fit(d)
    one = probs(ML.text_classifier_score(m, d, keep=["recipe_id"]))
    monkeypatch.setattr(X, "MAX_ENTRIES", 0)
    assert all(np.allclose(v, here[k], atol=1e-9) for k, v in probs(ML.out_of_fold_scores(d, "text", "label", "recipe_id")).items())
    there = probs(ML.text_classifier_score(m, d, keep=["recipe_id"]))
    assert there.keys() == one.keys() and all(np.allclose(v, one[k], atol=1e-9) for k, v in there.items())
    assert all(abs(sum(v) - 1) < 1e-9 for v in there.values())


def test_naive_bayes_formula(spark):
    df = spark.createDataFrame([("b", "x x y"), ("b", "y"), ("a", "x z")], "label string, text string")
    m = ML.text_classifier_fit(df)
    got = ML.text_classifier_score(m, spark.createDataFrame([("X, y!",)], "text string")).first()
    z = {}
    for c, n, total, docs in (("a", {"x": 1, "y": 0}, 2, 1), ("b", {"x": 2, "y": 2}, 4, 2)):
        z[c] = np.log((docs + 1) / 5) + sum(np.log((n[t] + 1) / (total + m.buckets)) for t in "xy")
    e = {c: np.exp(v - max(z.values())) for c, v in z.items()}
    assert abs(got["prob_a"] - e["a"] / sum(e.values())) < 1e-12


def test_counts_are_combined_before_the_exchange(spark):
    d = add_text_column(recipes_d(spark, SF_MID))
    plan = X.token_counts(d)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count(1)") == 1 and plan.count("partial_sum(") == 1


def test_tokens_are_counted_by_batches(spark, monkeypatch):
    """No row a token leaves the scan, and giving counts out early changes none."""
    odd = spark.createDataFrame([(0, "a", "Größe GRÖSSE x_y x"), (1, "a", None), (0, None, "ΣΑΣ İ ٣٤ ǅ"), (1, "b", ""), (0, "a", "x")],
                                "f int, label string, text string")
    assert "Generate" not in X.token_counts(odd, fold_col="f")._jdf.queryExecution().executedPlan().toString()
    each = odd.select("f", "label", F.explode(X.tokens(F.col("text"))).alias("w")).groupBy("f", "label", X.bucket(F.col("w")).alias("b")).count()
    docs = odd.groupBy("f", "label").count()
    due = sorted(map(str, [*map(tuple, each.collect()), *[(f, x, -1, n) for f, x, n in docs.collect()]]))
    for held in (X.HELD, 1):
        monkeypatch.setattr(X, "HELD", held)
        assert sorted(str(tuple(r)) for r in X.token_counts(odd, fold_col="f").collect()) == due


def test_models_are_dealt_by_cost():
    grid = ML.param_grid()
    costs = {i: N.NetworkKernel((12, *g["hidden"], 4), g["activation"], g["alpha"], g["rate"], 1).cost for i, g in enumerate(grid)}
    share = P.dealt(costs, 12)
    load = [sum(costs[i] for i in s) for s in share.values()]
    assert sorted(i for s in share.values() for i in s) == sorted(costs) and max(load) < 1.1 * min(load)


def test_steps_leave_the_state_as_it_was():
    rng = np.random.default_rng(1)
    block = {"features": rng.random(600), "label_idx": rng.integers(0, 3, 200).astype(float)}
    k = N.NetworkKernel((3, 4, 3), "tanh", 1e-3, 0.01, 1)
    s, adam = P.fresh(k), P.Adam(batch=50, decay=0.1)
    p, m, v = s.p.copy(), s.m.copy(), s.v.copy()
    got = P.advance(k, s, block, 200, 0, 2, adam, 5)
    step = 0
    for e in range(2):
        order = np.random.default_rng((5, e, 0)).permutation(200)
        for a in range(0, 200, 50):
            _, g = k.gradient(p, block, order[a:a + 50])
            step += 1
            m, v = 0.9 * m + (1 - 0.9) * g, 0.999 * v + (1 - 0.999) * g * g
            p = p - 0.01 * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step) * m / (np.sqrt(v) + 1e-8) - 0.01 * 0.1 * p
    assert np.allclose(got[0], p, rtol=0, atol=1e-12) and got[3] == step and not s.m.any() and np.array_equal(s.p, k.start())


def test_saved_states(spark, tmp_dir):
    root = f"{tmp_dir}/states"
    assert P.last_state(spark, root) is None
    P.save_state(spark, root, 1, {"a": 1})
    P.save_state(spark, root, 2, {"a": 2})
    assert P.last_state(spark, root) == (2, {"a": 2})
