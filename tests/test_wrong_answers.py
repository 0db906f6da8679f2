"""Inputs that once gave silent wrong answers: each case fails on the old code."""

import os

import pytest
from pyspark.sql import functions as F

from penmark.functions import columns as C
from penmark.functions.lists import parse_list_strict, parse_list_tolerant
from penmark.operators.metrics import accuracy, classification_report
from penmark.operators.models import require_features
from penmark.operators.neighbours import knn_within_class
from penmark.operators.scaling import minmax_apply
from penmark.operators.smote import smote_oversample
from penmark.plans.jobs import predict_job, train_job
from penmark.sources.csv_scan import scan_strict, scan_tolerant, stage, write_recipes_csv
from penmark.sources.fixtures import recipes_d
from tests.conftest import SF_MID


def _one(spark, value, kind, fn):
    return spark.createDataFrame([(value,)], f"c {kind}").select(fn(F.col("c")).alias("x")).first()["x"]


def test_missing_values_do_not_scale(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (5.0,)], "x double")
    assert [r["norm_x"] for r in minmax_apply(df, {"x": (0.0, 10.0)}).collect()] == [None, None, 0.5]
    assert [r["norm_x"] for r in minmax_apply(df, {"x": (5.0, 5.0)}).collect()] == [None, None, 0.0]


@pytest.mark.parametrize("cell,expected", [
    ("['a'], ['b']", ["['a']", "['b']"]), (r"['\x41']", ["A"]), (r"['\xe9']", ["é"]), (r"['\101']", ["A"]),
    (r"['a\\d', 'b\'c']", ["a\\d", "b'c"]), ("[true]", ["True"]), ("[null, 'a']", [None, "a"]),
    ("['a']['b']", []), ("['a'] + ['b']", []), ("\t['a']\n", ["a"]), (" a ,\tb ", ["a", "b"]), ("{'a': 1, 'b': 2}", []),
])
def test_tolerant_list_cells(spark, cell, expected):
    assert _one(spark, cell, "string", parse_list_tolerant) == expected


def test_long_list_cell_stays_native(spark):
    cell = "[" + ", ".join(["'" + "x" * 50 + "\\'y'"] * 20000) + "]"
    assert len(_one(spark, cell, "string", parse_list_tolerant)) == 20000


@pytest.mark.parametrize("cell", ["[true]", "[null]", "['a\nb']", "['a']['b']", "['a'] + ['b']"])
def test_strict_list_rejects(spark, cell):
    with pytest.raises(Exception, match="malformed"):
        _one(spark, cell, "string", parse_list_strict)


@pytest.mark.parametrize("cell,expected", [("NaN", 0.0), ("7d", 0.0), ("7f", 0.0), ("0x1p3", 0.0), ("\t7.5\n", 7.5), ("1e3", 1000.0)])
def test_number_text(spark, cell, expected):
    assert _one(spark, cell, "string", C.coerce_double_default) == expected


@pytest.mark.parametrize("cell", ["7\t", "\n7", " 7 ", " 7"])
def test_label_white_space(spark, cell):
    assert _one(spark, cell, "string", C.trim_label) == "7"


def test_missing_prediction_counts_as_wrong(spark):
    df = spark.createDataFrame([("a", "a"), ("b", None)], "label string, prediction string")
    assert accuracy(df).first()["accuracy"] == 0.5
    rep = {r["cls"]: r for r in classification_report(df).collect()}
    assert rep["accuracy"]["f1"] == 0.5


def test_over_long_row_with_empty_first_extra_is_skipped(spark, tmp_dir):
    p = os.path.join(tmp_dir, "x.csv")
    with open(p, "w") as f:
        f.write("label;recipe_name;data\n1;a;x\n2;x;y;;zzz\n3;b;y\n")
    assert sorted(r["label"] for r in scan_tolerant(spark, p, list_cols=()).collect()) == ["1", "3"]


def test_knn_takes_text_ids_and_refuses_missing_values(spark):
    rows = [(f"r{i}", "a", [float(i), 0.0]) for i in range(6)]
    df = spark.createDataFrame(rows, "id string, label string, v array<double>")
    got = {(r["q_id"], r["c_id"]) for r in knn_within_class(df, "id", "label", "v", k=1).collect()}
    assert ("r0", "r1") in got and ("r5", "r4") in got and len(got) == 6
    bad = df.union(spark.createDataFrame([("x", "a", [float("nan"), 1.0])], df.schema))
    with pytest.raises(Exception, match="not finite"):
        knn_within_class(bad, "id", "label", "v", k=1).collect()


def test_small_class_raises_or_shrinks(spark):
    df = spark.createDataFrame([(i, "a", [float(i)]) for i in range(8)] + [(9, "b", [1.0])], "id long, label string, v array<double>")
    with pytest.raises(Exception, match="too few rows"):
        smote_oversample(df, "id", "label", "v", k=5).collect()
    out = smote_oversample(df, "id", "label", "v", k=5, small_class="shrink")
    assert out.where("label = 'b'").count() == 8


def test_missing_feature_is_named(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(Exception, match="feature b is missing"):
        require_features(df, ["a", "b"]).collect()


def test_file_without_key_trains_and_predicts_in_file_order(spark, tmp_dir):
    d = recipes_d(spark, SF_MID).coalesce(1).orderBy("recipe_id")
    path = write_recipes_csv(d.drop("recipe_id").withColumnRenamed("label", "author"), os.path.join(tmp_dir, "f"))
    rows = stage(scan_strict(spark, path, types={"author": "string"}, label="author"))
    assert rows.rdd.getNumPartitions() > 1
    res = train_job(rows, label="author", mlp_params={"hidden": (8,), "max_iter": 20})
    pred = predict_job(rows.drop("author"), res.artifacts).orderBy("recipe_id").collect()
    names = [r["recipe_name"] for r in rows.orderBy("recipe_id").collect()]
    assert names == [r["recipe_name"] for r in d.collect()] and len(pred) == len(names)
