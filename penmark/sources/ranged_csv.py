"""Delimited text with quoted, multi-line cells, read in parallel byte ranges.

Spark's text reader hands out a file's lines in byte ranges.  Whether a range
begins inside a quoted cell depends on everything before it, so the file is read
twice:

1. each range is run from both possible states (outside, inside a quoted cell)
   and yields where either ends and how many records begin in it: one row a range;
2. a running composition of those effects over a file's ranges gives every
   range its true first state, the number of its first record, and the number of
   the record that is open at its start;
3. each range is read again from its true state.  Records that lie within it are
   cut into cells, what is left at its two borders goes out as pieces, and pieces
   of one record, which may span many ranges, are put together by that number.

Rows come out as ``c0 .. cN-1`` by the header's columns, with the record's true
number of cells and its number in file order (files by name).  A quote opens a
cell only at the cell's start and is literal elsewhere in an open one; two quotes
inside a quoted cell are one.  Lines end at ``\\n`` or ``\\r\\n``, blank lines
outside quotes are skipped, a cell still quoted at the end of the file ends there.
"""

from __future__ import annotations

import contextlib
import csv
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from penmark.operators.joins import MAX_BROADCAST_BYTES
from penmark.session import cut_lineage

#: The text to a closing quote, doubled quotes passed over.
CLOSING = re.compile(r'(?:[^"]++|"")*+"')
BLANK = " \t\r"
QUOTE, CARRIAGE_RETURN = ord('"'), ord("\r")
EFFECT = "file string, start long, length long, end0 boolean, end1 boolean, n0 long, n1 long"
#: Bytes that a range's row takes in a broadcast, at most: hash, two offsets, state, three numbers.
RANGE_BYTES = 64


# ------------------------------------------------------------ one line, one record

def ends_open(line: str, is_open: bool, sep: str) -> bool:
    """Whether a line leaves a quoted cell open, given whether it begins in one."""
    opening, at = sep + '"', 0
    if not is_open:
        if line.startswith('"'):
            at = 1
        else:
            at = line.find(opening) + len(opening)
            if at < len(opening):
                return False
    while True:
        closed = CLOSING.match(line, at)
        if closed is None:
            return True
        at = line.find(opening, closed.end()) + len(opening)
        if at < len(opening):
            return False


def cells_of(records: list[str], sep: str) -> list[list[str]]:
    """The cells of whole records."""
    csv.field_size_limit(sys.maxsize)
    out: list[list[str]] = []
    quoted: list[str] = []
    at: list[int] = []
    for r in records:
        r = r[:-1] if r.endswith("\r") else r
        if '"' in r or "\r" in r:
            at.append(len(out))
            out.append([])
            quoted.append(r)
        else:
            out.append(r.split(sep))
    held = next(c for c in map(chr, range(0xE000, 0xF8FF)) if not any(c in r for r in quoted)) if any("\r" in r for r in quoted) else ""
    if held:            # the reader below would end a record there
        quoted = [r.replace("\r", held) for r in quoted]
    for i, row in zip(at, csv.reader(quoted, delimiter=sep, quotechar='"', doublequote=True)):
        out[i] = [c.replace(held, "\r") for c in row] if held else row
    return out


# -------------------------------------------------------------- passes over ranges

def runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch cut where the range changes."""
    start, file = batch["start"].to_numpy(), batch["file_hash"].to_numpy()
    cuts = np.flatnonzero((start[1:] != start[:-1]) | (file[1:] != file[:-1])) + 1
    for a, b in zip([0, *cuts], [*cuts, len(start)]):
        if b > a:
            yield batch.slice(a, b - a)


@dataclass(frozen=True)
class Quotes:
    """The runs of quotes in a batch of lines and what they do to the state.

    Pairs leave it as it is.  An odd run at a cell's start opens a quoted cell or closes
    the open one; an odd run elsewhere closes the open one and is text outside."""
    at: np.ndarray              # every quote
    begin: np.ndarray           # runs
    end: np.ndarray
    turned: np.ndarray          # after a run: turned over (since the last closing run, if there was one)
    fixed: np.ndarray           # whether there was one

    def before(self, places: np.ndarray, is_open: bool) -> np.ndarray:
        """Whether a quoted cell is open at the places, by the state before the first line."""
        i = np.searchsorted(self.begin, places) - 1
        if not len(self.begin):
            return np.full(len(places), is_open)
        return np.where(i < 0, is_open, self.turned[i] ^ (~self.fixed[i] & is_open))


def buffers(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, where each line begins and the last one ends) of an array of text."""
    lines = lines.cast(pa.string())
    at = np.frombuffer(lines.buffers()[1], np.int32)[lines.offset:lines.offset + len(lines) + 1]
    data = lines.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), at.astype(np.int64)


def quotes_of(data: np.ndarray, at: np.ndarray, sep: bytes) -> Quotes:
    q = np.flatnonzero(data[at[0]:at[-1]] == QUOTE) + at[0]
    line = at[np.searchsorted(at, q, "right") - 1]
    first = np.flatnonzero(np.concatenate([[True], (q[1:] != q[:-1] + 1) | (q[1:] == line[1:])])[:len(q)])
    begin, line = q[first], line[first]
    size = np.diff(np.append(first, len(q)))
    leads = begin - len(sep) >= line
    for i, c in enumerate(sep):
        leads &= data[np.maximum(begin - len(sep) + i, 0)] == c
    leads |= begin == line
    odd = size % 2 == 1
    turns = np.cumsum(odd & leads)
    closing = np.maximum.accumulate(np.where(odd & ~leads, np.arange(len(begin)), -1))
    since = turns - np.where(closing >= 0, turns[closing], 0) if len(begin) else turns
    return Quotes(q, begin, begin + size, since % 2 == 1, closing >= 0)


def filled_lines(lines: pa.Array, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a line holds more than blanks."""
    out = at[1:] > at[:-1]
    doubtful = np.flatnonzero(out)
    doubtful = doubtful[np.isin(data[at[doubtful]], np.frombuffer(BLANK.encode(), np.uint8))]
    if len(doubtful):
        out[doubtful] = pc.binary_length(pc.utf8_trim(lines.take(pa.array(doubtful)), BLANK)).to_numpy() > 0
    return out


def effects(sep: str):
    """Arrow pass: for each range its end and its records from either first state."""
    def run(batches):
        key, state, n, info = None, [False, True], [0, 0], None

        def done():
            file, start, length = info
            return pa.RecordBatch.from_pylist([{"file": file, "start": start, "length": length, "end0": state[0], "end1": state[1],
                                                "n0": n[0], "n1": n[1]}])
        for batch in batches:
            for part in runs(batch):
                mine = part["file_hash"][0].as_py(), part["start"][0].as_py()
                if mine != key:
                    if key is not None:
                        yield done()
                    key, state, n = mine, [False, True], [0, 0]
                    info = part["file"][0].as_py(), part["start"][0].as_py(), part["length"][0].as_py()
                lines = part["value"]
                data, at = buffers(lines)
                found, filled = quotes_of(data, at, sep.encode()), filled_lines(lines, data, at)
                for s in (0, 1):
                    inside = found.before(at, state[s])
                    n[s] += int((filled & ~inside[:-1]).sum())
                    state[s] = bool(inside[-1])
        if key is not None:
            yield done()
    return run


def columns(rows: list[list[str]], width: int) -> list[pa.Array]:
    return [pa.array([r[i] if i < len(r) else None for r in rows], pa.string()) for i in range(width)]


def row_batch(numbers: list[int], rows: list[list[str]], pieces: list[tuple[int, int, str]], width: int) -> pa.RecordBatch:
    """Whole rows first, then pieces (record, place, text) without cells."""
    blank = [[] for _ in pieces]
    cells = columns([*rows, *blank], width)
    return pa.RecordBatch.from_arrays(
        [pa.array([*numbers, *[p[0] for p in pieces]], pa.int64()), pa.array([*[len(r) for r in rows], *[None] * len(pieces)], pa.int32()),
         pa.array([*[None] * len(rows), *[p[1] for p in pieces]], pa.int64()), pa.array([*[None] * len(rows), *[p[2] for p in pieces]], pa.string()), *cells],
        names=["row", "n_cells", "place", "piece", *[f"c{i}" for i in range(width)]])


def row_schema(width: int) -> str:
    return ", ".join(["row long, n_cells int, place long, piece string", *[f"c{i} string" for i in range(width)]])


def whole_records(text: pa.Buffer, data: np.ndarray, found: Quotes, begin: np.ndarray, end: np.ndarray, numbers: np.ndarray,
                  is_open: bool, sep: str, width: int) -> Iterator[pa.RecordBatch]:
    """Rows of the records that lie in the text from ``begin`` to ``end``.

    Cells are cut at the separators outside quotes, all records at once.  A record with text
    behind a closing quote is left to the reader of single records."""
    if not len(begin):
        return
    mark = sep.encode()
    line_end, end = end, end - (data[end - 1] == CARRIAGE_RETURN)
    p = np.flatnonzero(data == mark[0])
    for i, c in enumerate(mark[1:], 1):
        p = p[(p + i < len(data)) & (data[np.minimum(p + i, len(data) - 1)] == c)]
    r = np.searchsorted(begin, p, "right") - 1
    kept = (r >= 0) & (p < end[r]) & ~found.before(p, is_open)
    p, r = p[kept], r[kept]
    a, b = np.sort(np.concatenate([begin, p + len(mark)])), np.sort(np.concatenate([p, end]))
    n = np.bincount(r, minlength=len(begin)) + 1
    base = np.cumsum(n) - n
    quoted = np.flatnonzero((a < b) & (data[np.minimum(a, len(data) - 1)] == QUOTE))
    doubled = np.zeros(len(a), bool)
    odd = np.zeros(len(begin), bool)
    if len(quoted):
        last = np.searchsorted(found.begin, b[quoted]) - 1
        clean = (found.end[last] == b[quoted]) & ((found.begin[last] == a[quoted]) | found.before(found.begin[last], is_open))
        odd[np.searchsorted(base, quoted[~clean], "right") - 1] = True
        quoted = quoted[clean]
        doubled[quoted] = np.searchsorted(found.at, b[quoted]) - np.searchsorted(found.at, a[quoted]) > 2
        a[quoted] += 1
        b[quoted] -= 1
    if odd.any():
        whole = [data[x:y].tobytes().decode() for x, y in zip(begin[odd], line_end[odd])]
        yield row_batch(numbers[odd].tolist(), cells_of(whole, sep), [], width)
        n, base, numbers = n[~odd], base[~odd], numbers[~odd]
    # the cells and the gaps between them, in turn, as one array over the text
    places = pa.py_buffer(np.stack([a, b], 1).reshape(-1).astype(np.int32))
    cells = pa.StringArray.from_buffers(2 * len(a) - 1, places, text)
    out = []
    for i in range(width):
        there = n > i
        at = np.where(there, base + i, 0)
        c = cells.take(pa.array(2 * at, mask=~there))
        pairs = there & doubled[at]
        if pairs.any():
            pairs = pa.array(pairs)
            c = pc.replace_with_mask(c, pairs, pc.replace_substring(c.filter(pairs), '""', '"'))
        out.append(c)
    yield pa.RecordBatch.from_arrays(
        [pa.array(numbers, pa.int64()), pa.array(n, pa.int32()), pa.nulls(len(n), pa.int64()), pa.nulls(len(n), pa.string()), *out],
        names=["row", "n_cells", "place", "piece", *[f"c{i}" for i in range(width)]])


def rows_of(sep: str, width: int):
    """Arrow pass: rows of the records inside each range, and pieces of those that
    cross its borders, by the number of the record."""
    def run(batches):
        key, row, held, is_open, place, pieces = None, 0, [], False, 0, []

        def border():
            """What is open at a range's end is a piece of the record that began last."""
            if held:
                pieces.append((row - 1, place, "\n".join(held)))
            out, pieces[:], held[:] = list(pieces), [], []
            return out

        for batch in batches:
            for part in runs(batch):
                mine = part["file_hash"][0].as_py(), part["start"][0].as_py()
                if mine != key:
                    out = border()
                    key, is_open = mine, part["is_open"][0].as_py()
                    # an open record began before this range: its number is the one before the range's first
                    row, place, entered = part["first_row"][0].as_py(), mine[1], is_open
                    if out:
                        yield row_batch([], [], out, width)
                plain = part["value"].cast(pa.string())
                lines = pc.binary_join_element_wise(plain, "", "\n")      # each line with its end
                data, at = buffers(lines)
                found = quotes_of(data, at, sep.encode())
                inside = found.before(at, is_open)
                ends = np.flatnonzero(~inside[1:])          # lines after which no cell is open
                first = 0
                if is_open:                                 # lines of a record that began before
                    first = int(ends[0]) + 1 if len(ends) else len(lines)
                    held += plain.slice(0, first).to_pylist()
                    if len(ends):
                        record = "\n".join(held)
                        held.clear()
                        if entered:
                            pieces.append((row - 1, place, record))
                            entered = False
                        else:
                            yield row_batch([row - 1], cells_of([record], sep), [], width)
                begun = np.flatnonzero(filled_lines(plain, *buffers(plain)) & ~inside[:-1])
                numbers = row + np.arange(len(begun))
                row += len(begun)
                over = ends[np.minimum(np.searchsorted(ends, begun), max(0, len(ends) - 1))] if len(ends) else begun
                if inside[-1] and len(begun) and first < len(lines):        # the last one is still open
                    held += plain.slice(int(begun[-1])).to_pylist()
                    begun, over, numbers = begun[:-1], over[:-1], numbers[:-1]
                yield from whole_records(lines.buffers()[2], data, found, at[begun], at[over + 1] - 1, numbers, is_open, sep, width)
                is_open = bool(inside[-1])
        if key is not None and (out := border()):
            yield row_batch([], [], out, width)
    return run


def stitched(sep: str, width: int):
    def run(batches):
        for b in batches:
            rows = cells_of(b["record"].to_pylist(), sep)
            yield row_batch(b["row"].to_pylist(), rows, [], width)
    return run


# ----------------------------------------------------------------------------- Spark

@contextlib.contextmanager
def same_ranges(spark: SparkSession):
    """Both passes must see the same ranges, also when executors come or go in
    between: their number is held fixed instead of following the cores."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    spark.conf.set(name, before or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """Lines in file order within each range, with the range's place."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select("value", F.col("_metadata.file_path").alias("file"), F.xxhash64("_metadata.file_path").alias("file_hash"),
                    F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_block_length").alias("length")))


def first_states(ranges: DataFrame) -> DataFrame:
    """(file_hash, start, length, is_open, first_row) of every range.

    A range's effect sets the state, keeps it or turns it over; a state is what
    the last setting range left, turned over as often as ranges did since.  ``head``
    marks a file's first range, whose first record is the header."""
    same = F.col("end0") == F.col("end1")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    turned = F.sum(F.when(~same & F.col("end0"), 1).otherwise(0))
    r = ranges.withColumn("turns", turned.over(upto)).withColumn("__set", same)
    left = F.coalesce(F.last(F.when(F.col("__set"), F.col("end0")), ignorenulls=True).over(before), F.lit(False))
    since = (F.coalesce(F.last("turns").over(before), F.lit(0))
             - F.coalesce(F.last(F.when(F.col("__set"), F.col("turns")), ignorenulls=True).over(before), F.lit(0)))
    r = r.withColumn("is_open", left != (since % 2 == 1))
    begun = F.when(F.col("is_open"), F.col("n1")).otherwise(F.col("n0"))
    first = F.row_number().over(Window.partitionBy("file").orderBy("start")) == 1
    r = r.withColumn("begun", begun).withColumn("head", F.when(first, 1).otherwise(0))
    # one row a range: a running sum over them in file order
    order = Window.orderBy("file", "start")
    r = r.withColumn("first_row", F.sum("begun").over(order) - F.col("begun"))
    return r.select(F.xxhash64("file").alias("file_hash"), "start", "length", "is_open", "first_row", "head")


def read_rows(spark: SparkSession, path: str, width: int, sep: str = ";") -> DataFrame:
    """(row, n_cells, c0 .. c<width-1>) of every record but the files' headers.

    The cells are written to the shared folder, so a text is parsed once and
    later reads are columns of Parquet."""
    with same_ranges(spark):
        lines = lines_of(spark, path)
        found = cut_lineage(lines.mapInArrow(effects(sep), EFFECT), "ranges")
        states = cut_lineage(first_states(found), "states")
        small = states.count() * RANGE_BYTES <= MAX_BROADCAST_BYTES
        keys = ["file_hash", "start", "length"]
        tied = lines.withColumn("__pm_at", F.monotonically_increasing_id())
        if small:
            tied = tied.join(F.broadcast(states), keys, "left")
        else:           # the ranges' rows come together again in their order
            tied = (tied.join(states, keys, "left").repartition("file_hash", "start")
                    .sortWithinPartitions("file_hash", "start", "__pm_at"))
        missing = F.raise_error(F.lit("byte ranges changed while a file was read")).cast("boolean")
        tied = tied.select("value", "file_hash", "start", F.coalesce("is_open", missing).alias("is_open"), "first_row")
        rows = cut_lineage(tied.mapInArrow(rows_of(sep, width), row_schema(width)), "rows")
    headers = states.where(F.col("head") == 1).select(F.col("first_row").alias("row"))
    cells = [f"c{i}" for i in range(width)]
    pieces = rows.where(F.col("piece").isNotNull()).select("row", F.struct("place", "piece").alias("p"))
    record = F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["piece"]), "\n")
    joined = pieces.groupBy("row").agg(record.alias("record")).mapInArrow(stitched(sep, width), row_schema(width))
    out = rows.where(F.col("piece").isNull()).select("row", "n_cells", *cells).unionByName(joined.select("row", "n_cells", *cells))
    return out.join(F.broadcast(headers) if small else headers, "row", "left_anti")
