"""Best-fit packing planned on a histogram of lengths.

Documents become pieces of at most ``capacity`` tokens.  Only the histogram
(at most ``capacity`` rows) reaches the driver, which packs counts: whole runs
of equal pieces take equal slots, best fit first for the longest.  The plan
holds runs (length, ranks from..to -> sequences from.., offset); every piece
gets a rank among the pieces of its length and takes the slot the plan names.

Defined results: a null or empty text has the end token only; a text that
repeats is packed once per row; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from penmark.session import cut_lineage

CAPACITY = 2048
END_TOKEN = 0
#: Characters whose classes every version of Unicode agrees on; a text with
#: others is encoded by the tokenizer itself.
SAFE = frozenset(map(chr, range(0x180))) | frozenset("‘’“”–—…€")


class Encoder:
    """Text -> its ids as little-endian unsigned 32-bit bytes.

    ``json_path`` is the tokenizer, ``ranks_path`` the same vocabulary as ranks,
    whose encoder gives the same ids four times as fast.
    """

    def __init__(self, json_path: str, ranks_path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(json_path)
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                       special_tokens={})

    def __call__(self, t: str | None) -> bytes:
        if not t:
            return b""
        if "<|endoftext|>" in t or not set(t) <= SAFE:
            ids = self.tokenizer.encode(t, add_special_tokens=False).ids
        else:
            ids = self.ranks.encode_ordinary(t)
        return np.array(ids, dtype="<u4").tobytes()


_ENCODERS: dict[str, Encoder] = {}
_PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long"


def _loaded(json_path: str, ranks_path: str) -> Encoder:
    if json_path not in _ENCODERS:
        _ENCODERS[json_path] = Encoder(json_path, ranks_path)
    return _ENCODERS[json_path]


def pieces(docs: DataFrame, json_path: str, ranks_path: str, capacity: int = CAPACITY,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: its document's tokens and the end token, cut into
    ``capacity`` tokens where longer; the first piece takes the rest."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = _loaded(json_path, ranks_path), np.array([END_TOKEN], dtype="<u4").tobytes()
        for b in batches:
            owner, piece, start, length, crc = [], [], [], [], []
            for i, t in enumerate(b.column(1)):
                ids = encode(t.as_py()) + end
                n, at, k = len(ids) // 4, 0, 0
                size = n % capacity or capacity
                while at < n:
                    owner.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(ids[4 * at:4 * (at + size)]))
                    at, k, size = at + size, k + 1, capacity
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(owner, pa.int32())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, _PIECES.format(id=id_type))


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts.

    Runs (length, rank from, rank to, first sequence, offset): the pieces of
    ``length`` with ranks from..to-1 go to consecutive sequences at ``offset``.
    Open sequences are kept as runs by free space, so the work follows the
    number of lengths, not of pieces.
    """
    free: dict[int, list[list[int]]] = {}          # free space -> runs [first sequence, how many]
    out, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = min((r for r in free if r >= length), default=None)
            if room is None:
                # as many new sequences as the rest fills with all each can take of this
                # length; what is over then opens one more
                n = max(1, left // (capacity // length))
                first, sequences = sequences, sequences + n
                free.setdefault(capacity, []).append([first, n])
                continue
            run = free[room].pop()
            if not free[room]:
                del free[room]
            n = min(run[1], left)
            out.append((length, rank, rank + n, run[0], capacity - room))
            if room > length:
                free.setdefault(room - length, []).append([run[0], n])
            if run[1] > n:
                free.setdefault(room, []).append([run[0] + n, run[1] - n])
            left, rank = left - n, rank + n
    return out


def pack(parts: DataFrame, capacity: int = CAPACITY, rows_per_bucket: int = 50_000) -> DataFrame:
    """``parts`` with ``sequence_id`` and ``offset``.

    The rank within a length is the row's number within (length, hash bucket)
    plus the counts of the buckets before it, so a length that a third of all
    pieces share is ranked by many tasks.
    """
    spark = parts.sparkSession
    staged = cut_lineage(parts, "pieces")
    total = staged.count()
    buckets = max(1, -(-total // rows_per_bucket))
    key = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int")
    rows = staged.withColumn("__pm_b", key)
    counts = cut_lineage(rows.groupBy("length", "__pm_b").agg(F.count(F.lit(1)).alias("__pm_n")), "lengths")
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("__pm_n")).collect()}
    w = Window.partitionBy("length").orderBy("__pm_b").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "__pm_b", F.coalesce(F.sum("__pm_n").over(w), F.lit(0)).alias("__pm_before"))
    inside = Window.partitionBy("length", "__pm_b").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (rows.withColumn("__pm_r", F.row_number().over(inside) - 1)
              .join(before, ["length", "__pm_b"])
              .withColumn("__pm_rank", F.col("__pm_r") + F.col("__pm_before")))
    runs = spark.createDataFrame(pd.DataFrame(plan(histogram, capacity) or [(0, 0, 0, 0, 0)],
                                              columns=["length", "__pm_from", "__pm_to", "__pm_seq", "offset"]),
                                 "length long, __pm_from long, __pm_to long, __pm_seq long, offset long")
    # the plan is bounded by the capacity, not by the data: a few runs for each length
    return (ranked.join(F.broadcast(runs), ["length"])
            .where("__pm_rank >= __pm_from and __pm_rank < __pm_to")
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    (F.col("__pm_seq") + F.col("__pm_rank") - F.col("__pm_from")).alias("sequence_id"), "offset"))
