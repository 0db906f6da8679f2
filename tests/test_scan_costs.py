"""Steps of the scans that cost by the cell or by the row group."""

import ast
import json

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from penmark.functions import lists as L
from penmark.sources import csv_scan, fixtures

ODD_NUMBERS = ["1", " 2 ", "+3", "-4", "5.", ".5", "1e3", "1E-3", "0x1p3", "0x1.8P1", "1d", "2F", "3.5D", "NaN", "nan", "+NaN", "-Infinity", "inf",
               "+inf", "INFINITY", "\t7\n", "9223372036854775807", "9223372036854775808", "1.0", "", " ", "3/4/1995", "1,5", "a", "e5", "x1", "1 2", "--1",
               "١", "1 ", "don't", "12:30", "infinit", "1_000", "1l"]


def test_guards_let_every_number_through(spark):
    """A cell that a cast can read is never kept from it, and plain text is."""
    df = spark.createDataFrame([(x,) for x in ODD_NUMBERS], "x string")
    whole, part = ~F.col("x").rlike(csv_scan.NO_INTEGER), F.col("x").rlike(csv_scan.LIKE_DOUBLE)
    for r in df.select("x", F.col("x").try_cast("bigint").alias("i"), F.col("x").try_cast("double").alias("d"), whole.alias("w"), part.alias("p")).collect():
        assert r.w or r.i is None, r.x
        assert r.p or r.d is None, r.x
    kept = df.where((F.col("x") == "3/4/1995") | (F.col("x") == "don't")).where(whole | part)
    assert kept.count() == 0


def test_bare_lists_are_cut_without_the_parser(spark):
    cells = ["['a', 'b']", "['', '']", "['a,b', \"c\"]", "['it', 'is', '']", '["a","b\'c",""]', '["a", "b"]', "['a','b']", "[]", "['']", "['a\\'b', 'c']",
             "['ä\U0001f600', 'tab\there']", '["q\\"uote","x"]', "['a', 'b'] ", "[ 'a', 'b']", "['a', 'b',]", "['a', 'b', 1]"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    for got in (L.parse_lists_strict(df, ["c"]), df.select("i", L.parse_list_strict(F.col("c")).alias("c")), L.parse_lists_tolerant(df, ["c"])):
        assert {r.i: r.c for r in got.collect()} == {i: [str(x) for x in ast.literal_eval(c.strip())] for i, c in enumerate(cells)}
    plain = [c for c in cells if json.dumps(c).count("\\\\") == 0]
    bare = df.select("c", (F.col("c").rlike(L.BARE_LIST.format(q="'", sep="', '")) | F.col("c").rlike(L.BARE_LIST.format(q='"', sep='","'))).alias("b"))
    found = [r.c for r in bare.collect() if r.b]
    assert "['a', 'b']" in found and '["a","b\'c",""]' in found and set(found) <= set(plain)


def test_one_row_group_is_dealt_out(spark, tmp_path):
    """A table that one task reads is cut and written by all of them, the rows unchanged."""
    n = 400
    t = pa.table({"doc_id": pa.array([*range(n - 2), 5, None], pa.int64()), "text": [f"line {i}\nword {i % 7}" for i in range(n - 1)] + [None],
                  "lang": ["en"] * n, "source": ["src1"] * n, "n_chars": [1] * n})
    pq.write_table(t, tmp_path / "documents.parquet")
    even, plain = fixtures.recipes_d(spark, str(tmp_path), even=True), fixtures.recipes_d(spark, str(tmp_path))
    assert even.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    assert sorted(map(str, even.collect())) == sorted(map(str, plain.collect()))
    pq.write_table(t.slice(0, 0), tmp_path / "empty.parquet")
    assert fixtures.spread(spark.read.parquet(str(tmp_path / "empty.parquet")), "doc_id").count() == 0
