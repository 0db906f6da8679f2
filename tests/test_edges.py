"""Edge rows for ingest, list parsing and scalar features (FIXTURES.md §2)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from penmark.functions import columns as C
from penmark.functions import features as FT
from penmark.functions.lists import parse_list_strict, parse_list_tolerant
from penmark.operators.scaling import minmax_apply
from penmark.sources.csv_scan import scan_inferred, scan_strict, scan_tolerant

EDGE_FILE = """label;recipe_name; tags ;steps;ingredients;n_ingredients;data
1;"x ""q"" y";"['a', ""it's""]";['it\\'s'];"['a', None]";2;1/4/2002
2;short
3;over;[];[];[];0;31/12/2000;extra
4;"two
lines";a, b,,c;{a, b};('a','b');7.9;31/12/2000
5;nan;;nan;5;x;
6;e;['a',];['a'] junk;NA;;1/1/2001
"""


@pytest.fixture()
def edge_path(tmp_dir):
    p = os.path.join(tmp_dir, "edge.csv")
    with open(p, "w") as f:
        f.write(EDGE_FILE)
    return p


def test_tolerant_scan_edges(spark, edge_path):
    rows = {r["label"]: r for r in scan_tolerant(spark, edge_path).collect()}
    assert sorted(rows) == ["1", "2", "4", "5", "6"]          # over-long row 3 skipped
    assert "tags" in rows["1"].asDict()                         # header name trimmed
    assert rows["1"]["recipe_name"] == 'x "q" y'
    assert rows["1"]["tags"] == ["a", "it's"]
    assert rows["1"]["steps"] == ["it's"]
    assert rows["1"]["ingredients"] == ["a", None]
    assert rows["2"]["recipe_name"] == "short" and rows["2"]["data"] is None
    assert rows["4"]["recipe_name"] == "two\nlines"
    assert rows["4"]["tags"] == ["a", "b", "c"]
    assert rows["4"]["steps"] == []
    assert rows["4"]["ingredients"] == ["a", "b"]
    assert rows["5"]["recipe_name"] is None and rows["5"]["ingredients"] == []
    assert rows["6"]["tags"] == ["a"] and rows["6"]["steps"] == [] and rows["6"]["ingredients"] == []


def test_inferred_scan_types(spark, edge_path):
    df = scan_inferred(spark, edge_path)
    types = dict(df.dtypes)
    assert types["label"] == "bigint" and types["n_ingredients"] == "string"
    with pytest.raises(RuntimeError):
        scan_inferred(spark, edge_path, label="author")


def test_strict_scan_fails_on_bad_rows(spark, edge_path):
    with pytest.raises(Exception):
        scan_strict(spark, edge_path).collect()


def test_strict_scan_good_file(spark, tmp_dir):
    p = os.path.join(tmp_dir, "good.csv")
    with open(p, "w") as f:
        f.write("label;recipe_name;tags;steps;ingredients;n_ingredients;data\n"
                "7;a;['x', 'y'];[];('p', 'q');2;31/12/2000\n")
    r = scan_strict(spark, p).first()
    assert r["label"] == 7 and r["n_ingredients"] == 2
    assert r["tags"] == ["x", "y"] and r["steps"] == [] and r["ingredients"] == ["p", "q"]
    assert r["data"] == dt.date(2000, 12, 31)


@pytest.mark.parametrize("cell,expected", [
    ("['a', \"it's\"]", ["a", "it's"]), ("['it\\'s']", ["it's"]), ("['a', None]", ["a", None]),
    ("['a',]", ["a"]), ("('a','b')", ["a", "b"]), ("[]", []), ("", []), ("nan", []), (None, []),
    ("a, b,,c", ["a", "b", "c"]), ("{a, b}", []), ("5", []), ("['a'] junk", []),
])
def test_parse_list_tolerant(spark, cell, expected):
    df = spark.createDataFrame([(cell,)], "c string")
    assert df.select(parse_list_tolerant(F.col("c")).alias("x")).first()["x"] == expected


@pytest.mark.parametrize("cell", ["5", "a, b", "", "['a'] junk"])
def test_parse_list_strict_rejects(spark, cell):
    df = spark.createDataFrame([(cell,)], "c string")
    with pytest.raises(Exception):
        df.select(parse_list_strict(F.col("c")).alias("x")).collect()


def test_scalar_features(spark):
    df = spark.createDataFrame([("a😀b", "1/4/2002"), ("", "31/12/2000")], "s string, d string")
    r = df.select(FT.text_length("s").alias("n"), FT.date_parse_dayfirst("d").alias("d")) \
        .select("n", "d", F.dayofyear("d").alias("doy")).collect()
    assert r[0]["n"] == 3 and r[0]["d"] == dt.date(2002, 4, 1)
    assert r[1]["doy"] == 366


def test_numeric_junk(spark):
    df = spark.createDataFrame([("7.9",), ("x",), (None,), ("-2.5",)], "c string")
    got = [r[0] for r in df.select(C.coerce_int_default("c")).collect()]
    assert got == [7, 0, 0, -2]


def test_text_concat_empty_list_keeps_blank(spark):
    df = spark.createDataFrame([("n", None, ["a"], [], ["t"])],
                               "recipe_name string, description string, ingredients array<string>, "
                               "steps array<string>, tags array<string>")
    assert FT.add_text_column(df).first()["text"] == "n  a  t"


def test_minmax_clip_and_degenerate(spark):
    df = spark.createDataFrame([(-1.0, 5.0), (11.0, 5.0), (5.0, 6.0)], "x double, y double")
    out = minmax_apply(df, {"x": (0.0, 10.0), "y": (5.0, 5.0)}).collect()
    assert [r["norm_x"] for r in out] == [0.0, 1.0, 0.5]
    assert [r["norm_y"] for r in out] == [0.0, 0.0, 1.0]


def test_numeric_first_order(spark):
    from penmark.operators.profile import numeric_first_order
    df = spark.createDataFrame([("10",), ("9",), ("b",), ("9",)], "label string")
    order = [r["label"] for r in numeric_first_order(df).orderBy("class_order").collect()]
    assert order == ["9", "10", "b"]
