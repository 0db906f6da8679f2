"""The parallel reader against a sequential one, over files of many byte ranges."""

import csv
import io
import os
import random
import sys

import pytest
from pyspark.sql import functions as F

from penmark.sources import ranged_csv
from penmark.sources.csv_scan import CSV_OPTS, scan_inferred, scan_strict, scan_tolerant

csv.field_size_limit(sys.maxsize)


@pytest.fixture()
def small_ranges(spark):
    """Ranges of about 64 bytes."""
    conf = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def write(path, text):
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def sequential(text):
    """Non-blank records of a file, header left out."""
    rows = [r for r in csv.reader(io.StringIO(text, newline="\n"), delimiter=";") if r and not (len(r) == 1 and not r[0].strip())]
    return rows[1:]


def read(spark, path, width):
    got = ranged_csv.read_rows(spark, path, width).orderBy("row").collect()
    assert [r["row"] for r in got] == sorted({r["row"] for r in got})
    return [(r["n_cells"], *[r[f"c{i}"] for i in range(width)]) for r in got]


def padded(rows, width):
    return [(len(r), *[r[i] if i < len(r) else None for i in range(width)]) for r in rows]


def cell(rng, stray):
    x = "".join(rng.choice(["a", "é", " ", "7", ";", "\n", '"', "\n\n", "z" * 9]) for _ in range(rng.randint(0, 12)))
    if any(c in x for c in ';\n"') or rng.random() < 0.3:
        return '"' + x.replace('"', '""') + '"'
    return (x or "e") + ('"q' if stray and rng.random() < 0.3 else "")


@pytest.mark.parametrize("seed", range(4))
def test_equal_to_a_sequential_reader(spark, tmp_dir, small_ranges, seed):
    rng = random.Random(seed)
    lines = [";".join(cell(rng, seed % 2) for _ in range(rng.choice([3, 3, 3, 2, 5]))) for _ in range(150)]
    lines += ['"' + "long\nrow " * 200 + '";x;y', '"' + "no quote here " * 60 + '";x;y', "", " \t", "u;v;w"]
    text = "h1;h2;h3\n" + "\n".join(lines) + ("\n" if seed else "")
    path = write(os.path.join(tmp_dir, "x.csv"), text)
    assert ranged_csv.lines_of(spark, path).select("start").distinct().count() > 20
    assert read(spark, path, 3) == padded(sequential(text), 3)


def test_equal_to_the_multi_line_reader(spark, tmp_dir, small_ranges):
    rng = random.Random(9)
    rows = [[rng.choice(["p", "q;r", 'say "so"', "two\nlines", "x\n\ny;\"z\"\n"]) + str(i) for _ in range(3)] for i in range(120)]
    path = os.path.join(tmp_dir, "d")
    spark.createDataFrame(rows, "a string, b string, c string").repartition(5).write.options(**CSV_OPTS).csv(path)
    want = sorted(tuple(r) for r in spark.read.options(**CSV_OPTS).csv(path).collect())
    assert sorted(r[1:] for r in read(spark, path, 3)) == want == sorted(tuple(r) for r in rows)


@pytest.mark.parametrize("text", ["h\n", "h", "h\n\n\n", "h;i\n1;2", 'h;i\n"1\n2', 'h;i\n1;"2\n;"\n', 'h\r\n1\r\n"a\r\nb"\r\n\r\n2\r\n', '"h\n2";i\n1;2\n', ""])
def test_ends_of_files(spark, tmp_dir, small_ranges, text):
    path = write(os.path.join(tmp_dir, "x.csv"), text)
    want = padded(sequential(text), 2)
    assert read(spark, path, 2) == want


def test_a_carriage_return_inside_an_open_cell_is_text(spark, tmp_dir):
    path = write(os.path.join(tmp_dir, "x.csv"), 'h;i\na\rb;"c\rd"\n')
    assert read(spark, path, 2) == [(2, "a\rb", "c\rd")]


def test_without_broadcast(spark, tmp_dir, small_ranges, monkeypatch):
    monkeypatch.setattr(ranged_csv, "MAX_BROADCAST_BYTES", 0)
    text = "h;i\n" + "".join(f'{i};"a\n{i};""b"\n' for i in range(80))
    path = write(os.path.join(tmp_dir, "x.csv"), text)
    assert read(spark, path, 2) == padded(sequential(text), 2)


def test_effect_of_a_line_from_either_state():
    for line in ['a;b', '"a;b', 'a"b', 'a;"b";"c', 'x";y', '"a""b";c', '""', '"""', ';"', 'a;""', '";"', '"";"']:
        for is_open in (False, True):
            # the sequential reader's state: another line's text would be its own record or not
            text = ('"' if is_open else "") + line + "\nprobe"
            rows = list(csv.reader(io.StringIO(text, newline="\n"), delimiter=";"))
            assert ranged_csv.ends_open(line, is_open, ";") == (rows[-1] != ["probe"]), (line, is_open)


def test_scans_judge_rows_by_their_cells(spark, tmp_dir, small_ranges):
    wide = "5;" + "n" + ";" * 90 + "late"
    text = "label;name\n1;a\n2;b;\n3;c;d\n4\n" + wide + '\n6;"f\n;g"\n'
    path = write(os.path.join(tmp_dir, "x.csv"), text)
    got = {r["label"]: r["name"] for r in scan_tolerant(spark, path, list_cols=()).collect()}
    assert got == {"1": "a", "4": None, "6": "f\n;g"}
    assert scan_inferred(spark, path).schema["label"].dataType.simpleString() == "bigint"
    with pytest.raises(Exception, match="cells where 2 are due"):
        scan_strict(spark, path, types={}).collect()


def test_rows_are_numbered_in_file_order(spark, tmp_dir, small_ranges):
    text = "label;name\n" + "".join(f'{i};"n\n{i}"\n' for i in range(100))
    path = write(os.path.join(tmp_dir, "x.csv"), text)
    got = scan_strict(spark, path, types={"label": "bigint"}).select("recipe_id", "label").collect()
    assert len(got) == 100 and all(r["recipe_id"] == r["label"] for r in got)


def test_changed_ranges_are_noticed(spark, tmp_dir, small_ranges):
    path = write(os.path.join(tmp_dir, "x.csv"), "h\n" + "row\n" * 200)
    real = ranged_csv.first_states
    try:
        ranged_csv.first_states = lambda r: real(r).withColumn("length", F.col("length") + 1)
        with pytest.raises(Exception, match="byte ranges changed"):
            ranged_csv.read_rows(spark, path, 1).collect()
    finally:
        ranged_csv.first_states = real


def test_quotes_of_many_lines_as_of_one(spark):
    """The state after each line, from either first state, by the rule for one line."""
    import numpy as np
    import pyarrow as pa
    rng = random.Random(5)
    for sep in (";", "§"):
        lines = ["".join(rng.choice([sep, '"', "a", "é"]) for _ in range(rng.randint(0, 8))) for _ in range(400)]
        part = pa.array(["left out", *lines]).slice(1)
        data, at = ranged_csv.buffers(part)
        found = ranged_csv.quotes_of(data, at, sep.encode())
        for is_open in (False, True):
            due = [is_open]
            for line in lines:
                due.append(ranged_csv.ends_open(line, due[-1], sep) if due[-1] or line.strip() else False)
            assert np.array_equal(found.before(at, is_open), due)


def test_records_of_a_batch_as_one_by_one():
    """Cells cut all at once: doubled quotes, text behind a closing quote, carriage returns, short and long rows."""
    import pyarrow as pa
    records = ['a;b;c', '"";"x;""y""\nz";""""', '"a"b;c', 'q"r;s"t";', ' ;\r;x\r', 'one', '1;2;3;4', '"k"\r']
    lines = [line for r in records for line in r.split("\n")]
    n = len(lines)
    batch = pa.RecordBatch.from_arrays([pa.array(lines), pa.array([7] * n), pa.array([0] * n), pa.array([False] * n), pa.array([3] * n)],
                                       names=["value", "file_hash", "start", "is_open", "first_row"])
    got = {r["row"]: r for b in ranged_csv.rows_of(";", 3)(iter([batch])) for r in b.to_pylist()}
    due = ranged_csv.cells_of(records, ";")
    assert sorted(got) == list(range(3, 3 + len(records)))
    for i, cells in enumerate(due):
        assert got[3 + i]["n_cells"] == len(cells)
        assert [got[3 + i][f"c{j}"] for j in range(3)] == (cells + [None] * 3)[:3]
