"""Substring dedup by content-defined chunks.

A gear hash rolls over a document's bytes; a chunk ends where its low-order
pattern matches, so boundaries follow the content and an insertion shifts only
the chunks next to it.  Chunks are compared by digest across all documents;
of equal chunks the one in the first row stays.  Runs of removable chunks of
``min_run`` bytes or more are cut out, shorter ones stay.

Most chunks occur once.  A first pass counts 8-byte hashes alone; those that
occur again mark a bitmap of fixed size, and only chunks it lets through (a false
hit is sorted out by its digest) are compared by digest.  Texts without a repeated
chunk go from the reader to the result; only the others meet their spans.

Defined results: a null text stays null, an empty one empty, both with nothing
removed; repeated rows are different documents, so the later one loses what it
shares with the first; extra columns are kept as they are; very long texts are read
whole; an empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest

from penmark.llm.common import by_bytes, mix64, numbered
from penmark.session import cut_lineage

#: The gear hash of a position depends on its last 16 bytes: what a repeated
#: passage loses before its first boundary grows with the reach.
REACH = 16
GEAR = (mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
#: Chunks of 31 bytes or so: several fit in the shortest run that is cut.
AVERAGE_BITS = 4
LEAST, MOST = 16, 256
MIN_RUN = 120
#: Bits of a hash that address a bitmap (8 MB).
BITS = 26
#: A chunk that more than 1 in ``HOT_SHARE`` chunks equal (and ``HOT_LEAST`` do) is
#: joined in ``SALTS`` parts; no more than ``HOT_SHARE`` chunks can be that frequent.
HOT_SHARE, HOT_LEAST, SALTS = 1 << 16, 1 << 12, 64
SLICE_ROWS = 256


def gear(data: np.ndarray) -> np.ndarray:
    """h[i] = sum over j < REACH of GEAR[data[i-j]] << j, by doubling the reach."""
    h = GEAR[data]
    reach = 1
    while reach < REACH:
        h[reach:] += h[:-reach] << np.uint32(reach)
        reach *= 2
    return h


def chunk_ends(data: bytes, bits: int = AVERAGE_BITS, least: int = LEAST, most: int = MOST) -> list[int]:
    """Ends of the chunks: a position whose top ``bits`` of the gear hash are
    zero, at ``least`` bytes after the last end; without one, ``most`` bytes."""
    n = len(data)
    if not n:
        return []
    marks = np.flatnonzero(gear(np.frombuffer(data, np.uint8)) >> np.uint32(32 - bits) == 0) + 1
    ends, at = [], 0
    for m in marks.tolist():
        while m - at > most:
            at += most
            ends.append(at)
        if m - at >= least:
            ends.append(m)
            at = m
    while n - at > most:
        at += most
        ends.append(at)
    if at < n:
        ends.append(n)
    return ends


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few rows: texts are turned into Python values a slice at a time."""
    for b in batches:
        for at in range(0, b.num_rows, SLICE_ROWS):
            yield b.slice(at, SLICE_ROWS)


def text_parts(batch: pa.RecordBatch):
    """(index, bytes) of a batch's texts, in runs of bounded bytes."""
    texts = batch.column(1).cast(pa.binary()).to_pylist()
    for lo, hi in by_bytes(texts):
        yield [(i, texts[i] or b"") for i in range(lo, hi)]


def repeated_hashes(rows: DataFrame, **size) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of the hashes of chunks that occur more than once, and of the hot ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            for part in text_parts(b):
                h = []
                for _, data in part:
                    at = 0
                    for e in chunk_ends(data, **size):
                        h.append(xxh3_64_intdigest(data[at:e]))
                        at = e
                u, n = np.unique(np.array(h, np.uint64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])

    hashes = rows.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1")
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    hot = max(HOT_LEAST, n_bytes // (size.get("least", LEAST) * HOT_SHARE))
    return bitmaps(hashes.select("h", (F.col("n") > hot).alias("hot")))


def bitmaps(hashes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The top ``BITS`` bits of hashes (h) as a bitmap, set by Spark, 64 bits a row;
    a second one of those marked ``hot``."""
    at = F.shiftrightunsigned("h", 64 - BITS)
    words = hashes.select(F.shiftright(at, 6).alias("w"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - BITS}) & 63 as int))").alias("bit"), "hot")
    t = words.groupBy("w").agg(F.bit_or("bit").alias("all"), F.coalesce(F.bit_or(F.expr("if(hot, bit, 0L)")), F.lit(0)).alias("hot")).toArrow()
    out = []
    for name in ("all", "hot"):
        bits = np.zeros(1 << (BITS - 6), np.uint64)
        bits[t["w"].to_numpy()] = t[name].to_numpy().view(np.uint64)
        out.append(bits)
    return out[0], out[1]


def marked(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h >> np.uint64(64 - BITS)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def chunks(rows: DataFrame, **size) -> DataFrame:
    """(__pm_row, start, length, d1, d2, again, hot): one row per chunk that may occur
    elsewhere; ``again`` marks a chunk that its own document holds earlier, ``hot`` one
    whose hash is among the hot (equal chunks are marked alike)."""
    rows = rows.select("__pm_row", "text")
    shared = rows.sparkSession.sparkContext.broadcast(repeated_hashes(rows, **size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, hot_bits = shared.value
        for b in slices(batches):
            for part in text_parts(b):
                owner, start, length, dig, again, hot = [], [], [], [], [], []
                for i, data in part:
                    ends = np.array(chunk_ends(data, **size), np.int64)
                    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                    h = np.fromiter((xxh3_64_intdigest(data[x:y]) for x, y in zip(begins.tolist(), ends.tolist())), np.uint64, len(ends))
                    seen = set()
                    found = marked(bits, h)
                    hot += marked(hot_bits, h[found]).tolist()
                    for at, e in zip(begins[:len(ends)][found].tolist(), ends[found].tolist()):
                        d = hashlib.blake2b(data[at:e], digest_size=16).digest()
                        owner.append(i)
                        start.append(at)
                        length.append(e - at)
                        dig.append(d)
                        again.append(d in seen)
                        seen.add(d)
                two = np.frombuffer(b"".join(dig), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(owner, pa.int32())), pa.array(start, pa.int32()),
                     pa.array(length, pa.int32()), pa.array(two[:, 0].copy()), pa.array(two[:, 1].copy()),
                     pa.array(again, pa.bool_()), pa.array(hot, pa.bool_())],
                    names=["__pm_row", "start", "length", "d1", "d2", "again", "hot"])

    return rows.mapInArrow(run, "__pm_row long, start int, length int, d1 long, d2 long, again boolean, hot boolean")


def removable(found: DataFrame) -> DataFrame:
    """(__pm_row, spans): chunks that an earlier row, or the same row before,
    also holds, gathered per row.  A hot chunk meets its first row in ``SALTS`` parts."""
    first = (found.groupBy("d1", "d2", "hot").agg(F.min("__pm_row").alias("__pm_first"), F.count(F.lit(1)).alias("__pm_n"))
             .where("__pm_n > 1").drop("__pm_n")
             .withColumn("__pm_part", F.explode(F.expr(f"sequence(0, if(hot, {SALTS - 1}, 0))"))))
    part = F.when(F.col("hot"), F.pmod(F.xxhash64("__pm_row", "start"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    return (found.withColumn("__pm_part", part).join(first.drop("hot"), ["d1", "d2", "__pm_part"])
            .where("again or __pm_row <> __pm_first")
            .groupBy("__pm_row").agg(F.collect_list(F.struct("start", "length")).alias("__pm_spans")))


def runs(spans: list[tuple[int, int]], data: bytes, min_run: int) -> list[tuple[int, int]]:
    """Maximal runs (start, end) of adjoining chunks of ``min_run`` bytes or
    more, drawn in to whole UTF-8 characters."""
    out, a, e = [], None, None
    for s, n in sorted(spans) + [(len(data) + 2, 0)]:
        if e == s:
            e = s + n
            continue
        if a is not None and e - a >= min_run:
            while a < e and data[a] & 0xC0 == 0x80:
                a += 1
            while e > a and e < len(data) and data[e] & 0xC0 == 0x80:
                e -= 1
            if e > a:
                out.append((a, e))
        a, e = s, s + n
    return out


def dedup(docs: DataFrame, text_col: str = "text", min_run: int = MIN_RUN, **size) -> DataFrame:
    """``docs`` with the text cut, and ``__pm_bytes``, ``__pm_removed`` and
    ``__pm_spans`` (start, length in bytes of the input) added."""
    names = docs.columns
    rows = numbered(docs, *names, name="chunked")
    spans = removable(chunks(rows.select("__pm_row", F.col(text_col).alias("text")), **size))
    spans = cut_lineage(spans, "spans")
    key = F.xxhash64("__pm_row")
    shared = docs.sparkSession.sparkContext.broadcast(bitmaps(spans.select(key.alias("h"), F.lit(False).alias("hot")))[0])
    keyed = rows.withColumn("__pm_key", key)

    def side(wanted: bool) -> DataFrame:
        """The rows that have spans and few others, or the rest."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches):
                has = marked(shared.value, b.column(b.num_columns - 1).to_numpy().view(np.uint64))
                yield b.filter(pa.array(has if wanted else ~has))
        return keyed.mapInArrow(run, keyed.schema).drop("__pm_key")

    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("length", T.IntegerType())]))
    # the rest needs no second worker: its sums are columns
    rest = (side(False).drop("__pm_row")
            .withColumn("__pm_bytes", F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long"))
            .withColumn("__pm_removed", F.lit(0).cast("long")).withColumn("__pm_cut", F.array().cast(span)))
    joined = side(True).join(spans.hint("merge"), "__pm_row", "left").drop("__pm_row")
    schema = joined.drop("__pm_spans").schema.add("__pm_bytes", "long").add("__pm_removed", "long").add("__pm_cut", span)
    text_at, span_at = joined.columns.index(text_col), joined.columns.index("__pm_spans")
    keep = [i for i, c in enumerate(joined.columns) if c != "__pm_spans"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts, spanned = b.column(text_at), b.column(span_at)
            size_, removed, cuts = [], [], []
            new = {}
            for i in range(b.num_rows):
                n = len(texts[i].as_buffer() or b"") if texts[i].is_valid else 0
                size_.append(n)
                got = []
                if spanned[i].is_valid:
                    data = texts[i].as_py().encode("utf-8", "surrogatepass")
                    got = runs([(x["start"], x["length"]) for x in spanned[i].as_py()], data, min_run)
                    if got:
                        at, parts = 0, []
                        for s, e in got:
                            parts.append(data[at:s])
                            at = e
                        new[i] = b"".join([*parts, data[at:]]).decode("utf-8", "replace")
                removed.append(sum(e - s for s, e in got))
                cuts.append([{"start": s, "length": e - s} for s, e in got])
            cols = [b.column(i) for i in keep]
            if new:
                out = texts.to_pylist()
                for i, t in new.items():
                    out[i] = t
                cols[keep.index(text_at)] = pa.array(out, texts.type)
            cols += [pa.array(size_, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(cuts, pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())])))]
            yield pa.RecordBatch.from_arrays(cols, names=[f"c{i}" for i in range(len(cols))])

    out = rest.unionByName(joined.mapInArrow(cut, schema))
    return out.withColumnRenamed("__pm_cut", "__pm_spans")
