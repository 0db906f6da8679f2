"""Exact repeated-substring removal by merging Burrows-Wheeler transforms.

Finds every string of ``length`` bytes that starts at two places or more, in
one document or several, and removes the bytes such strings cover.

1. *Anchors.*  Each window of ``length`` bytes is named by the smallest hash of
   the ``GRAM``-byte grams in it (the leftmost of equals).  Equal windows have
   equal anchors at equal offsets, so only fragments (runs of windows with one
   anchor) whose anchor occurs twice can hold a repeat.
2. *Shards.*  Equal fragments are counted, one of each goes on.  The fragments of
   an anchor meet in one bin of bounded size.
3. *Merge.*  A bin's shards get a Burrows-Wheeler transform each, over symbols of
   ``STEP`` bytes: the symbol before each suffix of the shard, in the suffixes'
   order.  The merge sees the transforms alone: an interleave of the shards' orders
   is refined, a pass reads the transforms in the interleave so far and deals the
   places out by the symbols read, which makes it right for ``STEP`` more bytes,
   without comparing or sorting suffixes of different shards.  Borders between
   unlike suffixes give the common prefixes; suffixes alone between two borders
   drop out.  After ``length`` bytes an interval with two occurrences or more is a
   repeat.
4. An anchor with more fragments than a bin may hold is split by the bytes that
   all windows of a short run share, down to single windows, whose equal copies
   are simply counted; no copy is left out.

Defined results: a null text counts as empty; rows that repeat are documents of
their own, so all their windows repeat; a null id stays null; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penmark.llm.common import mix64, row_key
from penmark.session import cut_lineage

LENGTH = 400
GRAM = 64
STEP = 16
SHARD_BYTES = 128 << 10
BIN_BYTES = 1 << 20
#: Windows per piece when an anchor's fragments exceed a bin.
WIDTHS = (16, 1)
#: A key that more than 1 in so many rows have is hot; there are never more such keys.
HOT = 4096
HOT_PARTS = 64
_POS = np.uint64((1 << 24) - 1)
_SEGMENT = 4 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_TABLE = mix64(np.arange(1, 257, dtype=np.uint64) * _ODD)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position on, by doubling."""
    h, size, factor = _TABLE[data], 1, int(_ODD)
    while size < GRAM:
        h = h[:-size] * np.uint64(factor) + h[size:]
        factor = factor * factor & 0xFFFFFFFFFFFFFFFF
        size *= 2
    return mix64(h)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:len(x) - (width - size)], x[width - size:]) if width > size else x


def fragments(data: bytes, length: int = LENGTH) -> list[tuple[int, int, int]]:
    """(anchor hash, start, bytes) of each run of windows with one anchor."""
    out = []
    for lo in range(0, max(1, len(data) - length + 1), _SEGMENT):       # long texts in pieces that share no window
        part = np.frombuffer(data, np.uint8)[lo:lo + _SEGMENT + length - 1]
        if len(part) < length:
            break
        h = gram_hashes(part)
        ranked = (h & ~_POS) | np.arange(len(h), dtype=np.uint64)
        at = (sliding_min(ranked, length - GRAM + 1) & _POS).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
        n = np.diff(np.append(first, len(at)))
        out += zip(h[at[first]].view(np.int64).tolist(), (first + lo).tolist(), (n + length - 1).tolist())
    return out


def occurrences(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(__pm_id, __pm_h, g, start, n, d1, d2): every fragment with its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            owner, g, start, n, dig = [], [], [], [], []

            def out():
                two = np.frombuffer(b"".join(dig), np.int64).reshape(-1, 2)
                take = pa.array(owner, pa.int32())
                return pa.RecordBatch.from_arrays(
                    [b.column(0).take(take), b.column(1).take(take), pa.array(g, pa.int64()), pa.array(start, pa.int32()),
                     pa.array(n, pa.int32()), pa.array(two[:, 0].copy()), pa.array(two[:, 1].copy())],
                    names=["__pm_id", "__pm_h", "g", "start", "n", "d1", "d2"])

            for i, t in enumerate(b.column(2)):
                data = t.as_buffer().to_pybytes() if t.is_valid else b""
                if len(data) < length:
                    continue
                for anchor, s, size in fragments(data, length):
                    owner.append(i)
                    g.append(anchor)
                    start.append(s)
                    n.append(size)
                    dig.append(xxhash.xxh3_128_digest(data[s:s + size]))
                if len(g) >= 50_000:
                    yield out()
                    owner, g, start, n, dig = [], [], [], [], []
            yield out()

    return docs.select(*row_key(), "text").mapInArrow(
        run, "__pm_id string, __pm_h long, g long, start int, n int, d1 long, d2 long")


def _deal(keys: np.ndarray) -> np.ndarray:
    """Stable order of small whole numbers."""
    return _sorted(keys, np.arange(len(keys)), len(keys))[0]


def _sorted(key: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions ``at`` in the order of their keys, ties by position; whether a key is
    new there): both packed into one number, which sorts faster than an order by keys."""
    bits = np.uint64(size.bit_length())
    packed = np.sort((key.astype(np.uint64) << bits) | at.astype(np.uint64))
    new = np.ones(len(at), bool)
    new[1:] = (packed[1:] >> bits) != (packed[:-1] >> bits)
    return (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64), new


def letters(text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The STEP bytes from positions ``at`` on as two whole numbers."""
    block = text[at[:, None] + np.arange(STEP)].view(">u8")
    return block[:, 0].astype(np.uint64), block[:, 1].astype(np.uint64)


def _ranks(new: np.ndarray, order: np.ndarray) -> np.ndarray:
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return rank


class Shard:
    """Burrows-Wheeler transform of some fragments over symbols of STEP bytes.

    ``suffix``: positions in the order of the ``length`` bytes from them on (ties by
    position), fragment ends first; ``before``: the symbol that precedes each, as its
    number in the shard's own sorted ``alphabet``, 0 at the start of a fragment;
    ``back``: the place, in this order, of the suffix that begins with that symbol.
    ``back`` is counted from ``before`` alone: the n-th occurrence of a symbol there is
    the n-th suffix that begins with it.
    """

    def __init__(self, text: np.ndarray, room: np.ndarray, left: np.ndarray, length: int):
        size = len(text)
        assert 3 * size.bit_length() <= 63, "a shard is less than 2 MB"
        every = np.arange(size)
        padded = np.concatenate((text, np.zeros(STEP, np.uint8))).astype(np.int64)
        word = padded[:size] << 24 | padded[1:size + 1] << 16 | padded[2:size + 2] << 8 | padded[3:size + 3]
        order, new = _sorted(word, every, size)
        rank, span = _ranks(new, order), 4
        while span < STEP:                  # ranks by 4 bytes, 8, 16; zeros behind the end
            key = rank * (size + 1)
            key[:max(0, size - span)] += rank[span:]
            order, new = _sorted(key, every, size)
            rank, span = _ranks(new, order), 2 * span
        at = order[left[order] >= STEP]
        new = np.ones(len(at), bool)
        new[1:] = rank[at[1:]] != rank[at[:-1]]
        self.alphabet = letters(text, at[new])
        code = np.zeros(size, np.int64)
        code[at] = np.cumsum(new)
        rank, span = code, STEP
        order, _ = _sorted(rank, every, size)
        while span < length:                # the order by twice as many bytes from that by span bytes
            longer = np.flatnonzero(left >= span)
            key = rank * (size + 1)
            key[longer] += rank[longer + span]
            order, new = _sorted(key, every, size)
            new[0] = False                  # the ends of fragments keep rank 0
            rank, span = _ranks(new, order), 2 * span
        self.suffix = order
        starts = room[order] < STEP
        self.before = np.where(starts, 0, code[np.where(starts, 0, order - STEP)])
        self.back = np.empty(size, np.int64)
        self.back[_deal(self.before)] = np.arange(size)


def common_alphabet(shards: list[Shard]) -> list[np.ndarray]:
    """For each shard the numbers of its symbols in the alphabet of all: sorted lists merged."""
    hi = np.concatenate([s.alphabet[0] for s in shards])
    lo = np.concatenate([s.alphabet[1] for s in shards])
    order = np.argsort(hi, kind="stable")           # runs in order: merged, not sorted
    h = hi[order]
    tied = np.zeros(len(h), bool)
    tied[1:] = h[1:] == h[:-1]
    tied[:-1] |= tied[1:]
    some = np.flatnonzero(tied)
    order[some] = order[some][np.lexsort((lo[order[some]], h[some]))]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (lo[order][1:] != lo[order][:-1])
    return np.split(_ranks(new, order), np.cumsum([len(s.alphabet[0]) for s in shards])[:-1])


def interleave(shards: list[Shard], length: int, prefixes: bool = True) -> list[np.ndarray]:
    """For each shard the common prefix, in whole symbols up to ``length`` bytes, that
    each place of its order shares with any other suffix of any shard; those of all
    ``length`` bytes alone without ``prefixes``.

    At first the shards' orders stand one behind the other.  A pass reads the
    transforms in the interleave so far, each shard's from front to back, and deals
    the places by the symbol read; that is the interleave for one symbol more.
    Borders lie between places whose symbols, or whose intervals before, differ; a
    place alone between two borders drops out with the prefix it has shared.
    """
    assert length % STEP == 0, "the length is whole symbols"
    numbers = common_alphabet(shards)
    sizes = np.cumsum([0] + [len(s.suffix) for s in shards])
    before = np.concatenate([np.concatenate(([0], n))[s.before] for s, n in zip(shards, numbers)]).astype(np.uint32)
    back = np.concatenate([s.back + at for s, at in zip(shards, sizes)]).astype(np.int32)
    shared = np.zeros(sizes[-1], np.int64)
    place = np.arange(sizes[-1], dtype=np.int32)
    block = np.zeros(len(place), np.int32)
    for done in range(STEP, length + 1, STEP):
        symbol = before[place]
        on = np.flatnonzero(symbol)
        dealt, new = _sorted(symbol[on], on, len(place))
        place, block = back[place[dealt]], block[dealt]
        border = new
        border[1:] |= block[1:] != block[:-1]
        more = np.flatnonzero(~(border & np.append(border[1:], True)[:len(border)]))
        place, block = place[more], np.cumsum(border, dtype=np.int32)[more]
        if prefixes or done == length:
            shared[place] = done
        if not len(place):
            break
    return np.split(shared, sizes[1:-1])


def repeats(parts: list[bytes], copies: list[int], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For each part: the byte ranges (start, stop) covered by strings of
    ``length`` bytes with two occurrences or more, a part counting as often as
    it has copies."""
    shards, held, size = [], [], 0

    def close(stop: int) -> None:
        lens = np.array([len(p) + 1 for p in parts[len(held):stop]])        # the place after the last byte is a suffix too
        first = np.concatenate(([0], np.cumsum(lens)))
        part = np.repeat(np.arange(len(lens)), lens)
        here = np.arange(first[-1])
        text = np.frombuffer(b"".join(p + b"\0" for p in parts[len(held):stop]), np.uint8)
        shards.append(Shard(text, here - first[part], first[part + 1] - 1 - here, length))
        held.extend((len(shards) - 1, f) for f in first[:-1])

    for i, p in enumerate(parts):
        size += len(p) + 1
        if size >= SHARD_BYTES:
            close(i + 1)
            size = 0
    if len(held) < len(parts):
        close(len(parts))
    common = []
    for shard, shared in zip(shards, interleave(shards, length, prefixes=False)):
        common.append(np.empty(len(shared), np.int64))
        common[-1][shard.suffix] = shared
    out = []
    for (shard, first), p, n in zip(held, parts, copies):
        windows = max(0, len(p) - length + 1)
        if n > 1:                           # a part with copies repeats wherever it holds a whole window
            out.append([(0, len(p))] if windows else [])
            continue
        at = np.flatnonzero(common[shard][first:first + windows] >= length)
        cut = np.flatnonzero(np.diff(at) > 1)
        out.append([(int(at[s]), int(at[e]) + length) for s, e in
                    zip(np.append(0, cut + 1), np.append(cut, len(at) - 1))] if len(at) else [])
    return out


_RANGES = "array<struct<a:int,b:int>>"
_KEY = ["g1", "g2", "d1", "d2"]


def sized(shards: DataFrame, size: str) -> DataFrame:
    """Distinct fragments, without their bytes, with their group's ``group_n``
    (how many) and ``group_bytes``; written, since several steps follow."""
    shards = cut_lineage(shards, "distinct")
    groups = cut_lineage(shards.groupBy("g1", "g2").agg(F.count(F.lit(1)).alias("group_n"), F.sum(size).alias("group_bytes"),
                                                        F.count(F.lit(1)).alias("__pm_n")), "groups")
    return cut_lineage(by_key(shards, groups, ["g1", "g2"], "__pm_n"), "sized")


def by_key(rows: DataFrame, keyed: DataFrame, keys: list[str], n: str) -> DataFrame:
    """``rows`` joined with ``keyed`` (a row for each key; ``n`` rows have it).

    A key that more than 1 in ``HOT`` rows have meets its row in ``HOT_PARTS`` parts;
    there are fewer than ``HOT`` such keys, so their list is small enough to be sent
    to every task.  ``keyed`` must be a written table."""
    least = (keyed.agg(F.sum(n)).first()[0] or 0) // HOT
    hot = keyed.where(F.col(n) > least).select(*keys, F.lit(HOT_PARTS).alias("__pm_parts"))
    left = (rows.join(F.broadcast(hot), keys, "left")
            .withColumn("__pm_part", F.pmod(F.xxhash64(*rows.columns), F.coalesce("__pm_parts", F.lit(1))).cast("int")).drop("__pm_parts"))
    last = F.when(F.col(n) > least, HOT_PARTS - 1).otherwise(0)
    right = keyed.withColumn("__pm_part", F.explode(F.sequence(F.lit(0), last))).drop(n)
    return left.join(right.hint("merge"), [*keys, "__pm_part"]).drop("__pm_part")


def lone(shards: DataFrame, size: str) -> DataFrame:
    """Ranges of groups of one distinct string: its windows occur as often as it
    has copies, so its bytes are not even needed."""
    return (shards.where("group_n = 1 and m > 1")
            .select(*_KEY, F.array(F.struct(F.lit(0).alias("a"), F.col(size).cast("int").alias("b"))).alias("ranges")))


def solve(frags: DataFrame, total: int, length: int = LENGTH, widths: tuple[int, ...] = WIDTHS,
          bin_bytes: int = BIN_BYTES) -> DataFrame:
    """(g1, g2, d1, d2, ranges) for the distinct fragments (g1, g2 group; d1, d2
    digest; m copies; group_bytes; data) of groups of two or more whose ranges are
    not empty.  ``total``: bytes of all groups that fit in a bin.

    Rows of a group never need more than a bin: larger groups are split.
    """
    bins = max(1, -(-total // (bin_bytes // 2)))
    binned = (frags.where(F.col("group_bytes") <= bin_bytes).select(*_KEY, "m", "data")
              .withColumn("bin", F.pmod(F.xxhash64("g1", "g2"), F.lit(bins))))

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        found = repeats([bytes(x) for x in pdf["data"]], pdf["m"].tolist(), length)
        out = pdf[_KEY].copy()
        out["ranges"] = [[{"a": a, "b": b} for a, b in r] for r in found]
        return out[[bool(r) for r in found]]

    done = binned.groupBy("bin").applyInPandas(merge, f"g1 long, g2 long, d1 long, d2 long, ranges {_RANGES}")
    large = frags.where(F.col("group_bytes") > bin_bytes)
    if large.limit(1).count() == 0:
        return done
    parts = cut_lineage(pieces(large, length, widths[0]), "pieces")
    distinct = parts.groupBy("p1", "p2", "e1", "e2").agg(F.sum("m").alias("m"), F.max("n").alias("n"))
    each = sized(distinct.select(F.col("p1").alias("g1"), F.col("p2").alias("g2"), F.col("e1").alias("d1"),
                                 F.col("e2").alias("d2"), "m", "n"), "n")
    inner = lone(each, "n")
    many = each.where("group_n > 1")
    fit = many.where(F.col("group_bytes") <= bin_bytes).agg(F.sum("n")).first()[0]
    if fit is not None or many.limit(1).count():
        bytes_of = parts.groupBy("p1", "p2", "e1", "e2").agg(F.first("data").alias("data"))
        data = many.join(bytes_of, (F.col("g1") == F.col("p1")) & (F.col("g2") == F.col("p2"))
                         & (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2"))).drop("p1", "p2", "e1", "e2")
        inner = inner.unionByName(solve(cut_lineage(data, "distinct"), fit or 0, length, widths[1:], bin_bytes))
    inner = inner.select(
        F.col("g1").alias("p1"), F.col("g2").alias("p2"), F.col("d1").alias("e1"), F.col("d2").alias("e2"), "ranges")
    back = (parts.drop("data", "m", "n").join(inner, ["p1", "p2", "e1", "e2"])
            .select(*_KEY, "off", F.explode("ranges").alias("r"))
            .groupBy(*_KEY).agg(F.collect_list(F.struct((F.col("r.a") + F.col("off")).alias("a"),
                                                        (F.col("r.b") + F.col("off")).alias("b"))).alias("ranges")))
    return done.unionByName(back)


def pieces(frags: DataFrame, length: int, width: int) -> DataFrame:
    """Fragments cut into pieces of up to ``width`` windows.

    Where a window lies from its anchor is the same in all copies, and so is
    the bin of ``width`` starts it falls in; the bytes shared by all windows of
    that bin name the piece's group (p1, p2), its own bytes the piece (e1, e2).
    A fragment's anchor is found again as its smallest gram hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["g1", "g2", "d1", "d2", "m", "off", "n", "p1", "p2", "e1", "e2", "data"]
        for b in batches:
            rows = []
            for r in b.to_pylist():
                data = r["data"]
                n = len(data) - length + 1
                h = gram_hashes(np.frombuffer(data, np.uint8))
                at = int(((h & ~_POS) | np.arange(len(h), dtype=np.uint64)).argmin())
                edge = [0, *(o for o in range(1, n) if (at - o) % width == width - 1), n]
                for lo, hi in zip(edge[:-1], edge[1:]):
                    piece = data[lo:hi - 1 + length]
                    # the bin of starts begin..end, counted from the anchor, and the bytes all its windows have
                    end = at - (at - lo) // width * width
                    begin = end - width + 1
                    p = np.frombuffer(xxhash.xxh3_128_digest(
                        f"{r['g1']},{r['g2']},{at - end},".encode() + data[end:begin + length]), np.int64).tolist()
                    e = np.frombuffer(xxhash.xxh3_128_digest(piece), np.int64).tolist()
                    rows.append((r["g1"], r["g2"], r["d1"], r["d2"], r["m"], lo, len(piece), *p, *e, piece))
                if len(rows) >= 10_000:
                    yield _batch(rows, names)
                    rows = []
            yield _batch(rows, names)

    return frags.select("g1", "g2", "d1", "d2", "m", "data").mapInArrow(
        run, "g1 long, g2 long, d1 long, d2 long, m long, off int, n long, p1 long, p2 long, e1 long, e2 long, data binary")


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(names)
    kinds = {"off": pa.int32(), "data": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.int64())) for c, n in zip(cols, names)], names=names)


def spans(docs: DataFrame, length: int = LENGTH, bin_bytes: int = BIN_BYTES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(candidates, ranges, keys): documents with an anchor that occurs twice
    (id, text, key), byte ranges to remove by key, and the candidates' keys."""
    occ = cut_lineage(occurrences(docs, length), "fragments")
    twice = cut_lineage(occ.groupBy("g").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "twice")
    again = cut_lineage(by_key(occ, twice, ["g"], "c"), "again")
    shards = (again.groupBy(F.col("g").alias("g1"), F.lit(0).cast("long").alias("g2"), "d1", "d2")
              .agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("__pm_h", "__pm_id", "start", "n")).alias("rep")))
    shards = sized(shards, "rep.n")
    many = shards.where("group_n > 1")
    reps = (many.select("rep.__pm_id", "rep.__pm_h", F.struct("g1", "g2", "d1", "d2", "m", "group_bytes", "rep.start", "rep.n").alias("f"))
            .groupBy("__pm_id", "__pm_h").agg(F.collect_list("f").alias("fs")))
    # these sides grow with the documents: joined by shuffle at every size, never broadcast while small
    keys = cut_lineage(again.select("__pm_id", "__pm_h").distinct(), "keys")
    candidates = cut_lineage(docs.select("doc_id", "text", *row_key())
                             .join(keys.hint("merge"), ["__pm_id", "__pm_h"], "left_semi"), "candidates")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["g1", "g2", "d1", "d2", "m", "group_bytes", "data"]
        for b in batches:
            rows = []
            for t, fs in zip(b.column(0), b.column(1)):
                data = t.as_buffer().to_pybytes()
                rows += [(*(f[k] for k in names[:-1]), data[f["start"]:f["start"] + f["n"]]) for f in fs.as_py()]
                if len(rows) >= 10_000:
                    yield _batch(rows, names)
                    rows = []
            yield _batch(rows, names)

    one = candidates.join(reps.hint("merge"), ["__pm_id", "__pm_h"])
    frags = cut_lineage(one.select("text", "fs").mapInArrow(
        fetch, "g1 long, g2 long, d1 long, d2 long, m long, group_bytes long, data binary"), "shards")
    total = many.where(F.col("group_bytes") <= bin_bytes).agg(F.sum("rep.n")).first()[0] or 0
    found = lone(shards, "rep.n").unionByName(solve(frags, total, length, bin_bytes=bin_bytes))
    found = cut_lineage(found.join(shards.select("g1", "g2", "d1", "d2", "m").hint("merge"), _KEY)
                        .select(F.col("g1").alias("g"), "d1", "d2", "ranges", "m"), "found")
    # a fragment's windows share an anchor, so it is shorter than two windows and its ranges are few
    ranges = (by_key(again, found, ["g", "d1", "d2"], "m")
              .select("__pm_id", "__pm_h", "start", F.explode("ranges").alias("r"))
              .groupBy("__pm_id", "__pm_h")
              .agg(F.collect_list(F.struct((F.col("start") + F.col("r.a")).alias("a"),
                                           (F.col("start") + F.col("r.b")).alias("b"))).alias("ranges")))
    return candidates, ranges, keys


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of byte ranges as maximal runs; adjoining ones are one run."""
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def dedup(docs: DataFrame, length: int = LENGTH, bin_bytes: int = BIN_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) per row of
    ``docs`` (doc_id, text); ``spans``: (start, length) of the removed runs."""
    candidates, ranges, keys = spans(docs, length, bin_bytes)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
              "spans array<struct<start:long,length:long>>")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [[], [], [], [], []]
            for t, rs in zip(b.column(1), b.column(2)):
                data = t.as_buffer().to_pybytes()
                runs = merged([(r["a"], r["b"]) for r in rs.as_py() or []])
                sha, at = hashlib.sha256(), 0
                for a, e in runs:
                    sha.update(data[at:a])
                    at = e
                sha.update(data[at:])
                row = (len(data), sum(e - a for a, e in runs), len(runs), sha.hexdigest(),
                       [{"start": a, "length": e - a} for a, e in runs])
                for c, v in zip(cols, row):
                    c.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(),
                     pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    some = candidates.join(ranges.hint("merge"), ["__pm_id", "__pm_h"], "left").select("doc_id", "text", "ranges").mapInArrow(cut, schema)
    text = F.coalesce(F.col("text"), F.lit(""))
    none = (docs.select("doc_id", *row_key(), F.octet_length(text).cast("long").alias("n_bytes"),
                        F.sha2(text.cast("binary"), 256).alias("kept_sha256"))
            .join(keys, ["__pm_id", "__pm_h"], "left_anti")
            .select("doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
                    "kept_sha256", F.expr("array()").cast("array<struct<start:long,length:long>>").alias("spans")))
    return some.unionByName(none)
