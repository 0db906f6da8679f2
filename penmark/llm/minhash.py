"""Near-duplicate groups with SuperMinHash.

Every distinct shingle of a document draws a random permutation of the
signature's slots; at its j-th step it offers ``j + u`` to the j-th slot of its
permutation.  A slot keeps its smallest offer.  Ranks of one element are
correlated over the slots, which lowers the estimate's variance, and once every
slot holds less than j the steps from j on cannot change anything: long
documents stop after a few.  Signatures are cut into bands; documents with an
equal band are candidates, checked on their full shingle sets, and links are
grouped by union-find.

Documents with equal shingle sets are one node, buckets with equal members one
bucket.  A bucket's members are first checked against a centre, so large groups
cost one check a member.  The centre is the member that stands in the largest
buckets: an original that many copies were drawn from shares most of their bands,
each copy only some of the others'.  Buckets whose members are still of several
groups are compared in blocks, by whole signature and then by text, and a block
gives out the links that join its groups.

Pairs are thinned before any text is read: by their sizes (exact), then by whole
signatures, of which at least ``ALIKE`` of the slots must agree; at 0.75 that
fails once in 10^10, against once in 50,000 for the bands.

Defined results: a null or empty text, or one without words, has no shingle and
is linked with nothing; a text of fewer than ``k`` words is one shingle; rows
that repeat an id are one document for the grouping; a null id has a null
component and is kept; extra columns are ignored; very long texts are read whole;
an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penmark.llm.common import by_bytes, mix64
from penmark.llm.components import components
from penmark.session import cut_lineage

K = 5
SLOTS, ROWS = 200, 5                      # 40 bands: a link at 0.75 is missed once in 50,000
PERCENT = 75
ALIKE = 0.55
#: Rounds of centres, and members compared with each other at once in what these leave open.
STARS, BLOCK = 2, 1024
_GOLD = np.uint64(0x9E3779B97F4A7C15)


class Words(dict):
    """Word -> 64-bit hash."""

    def __missing__(self, w: bytes) -> int:
        if len(self) >= 100_000:
            self.clear()
        v = self[w] = xxhash.xxh3_64_intdigest(w)
        return v


_WORDS = Words()


def shingles(text: str | None, k: int = K) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a whole text.

    ``bytes.lower`` lowers A-Z alone and ``bytes.split`` cuts at 0x20 and
    0x09-0x0D, which no UTF-8 sequence holds.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - k + 1)
    s = np.full(n, min(k, len(h)), np.uint64)
    for j in range(min(k, len(h))):
        s = mix64(s * _GOLD + h[j:j + n])
    return np.unique(s)


def superminhash(elements: np.ndarray, doc: np.ndarray, n_docs: int, slots: int = SLOTS) -> np.ndarray:
    """Signatures (n_docs x slots, 32-bit) of sets given as elements and their
    (ascending) documents, step by step over all documents at once."""
    empty = np.uint64(1) << np.uint64(63)
    sig = np.full((n_docs, slots), empty, np.uint64)
    flat = sig.reshape(-1)
    perm = None
    for j in range(slots):
        r = mix64(elements + np.uint64((j + 1) * int(_GOLD) & 0xFFFFFFFFFFFFFFFF))
        pick = j + ((r & np.uint64(0xFFFFFFFF)) * np.uint64(slots - j) >> np.uint64(32)).astype(np.int64)
        if j == 0:
            slot = pick
        else:
            if perm is None:            # the first step only swapped slot 0 with the one picked
                perm = np.tile(np.arange(slots, dtype=np.uint8), (len(elements), 1))
                i = np.arange(len(elements))
                perm[i, first] = 0
            i = np.arange(len(elements))
            slot = perm[i, pick].astype(np.int64)
            perm[i, pick] = perm[:, j]
        offer = (np.uint64(j) << np.uint64(32)) | (r >> np.uint64(32))
        np.minimum.at(flat, doc * slots + slot, offer)
        # a document goes on while a slot holds nothing from a step up to j
        open_ = (sig.max(1) >> np.uint64(32)) > j
        go = open_[doc]
        if not go.any():
            break
        if not go.all():
            elements, doc = elements[go], doc[go]
            perm = perm[go] if perm is not None else None
            pick = pick[go]
        if j == 0:
            first = pick
    return (mix64(sig) >> np.uint64(32)).astype(np.uint32)


def bands(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band."""
    n = sig.shape[1] // rows
    key = np.tile(np.arange(1, n + 1, dtype=np.uint64), (len(sig), 1))
    parts = sig.reshape(len(sig), n, rows).astype(np.uint64)
    for r in range(rows):
        key = mix64(key * _GOLD + parts[:, :, r])
    return key.view(np.int64)


def signatures(docs: DataFrame, k: int = K, slots: int = SLOTS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, bands, sig): d1, d2 are the digest of the set,
    ``sig`` a byte of each slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            for lo, hi in by_bytes(texts, 1 << 19):
                sets = [shingles(t, k) for t in texts[lo:hi]]
                lens = np.array([len(s) for s in sets])
                full = np.flatnonzero(lens)
                keys, short = [None] * len(sets), [None] * len(sets)
                if len(full):
                    sig = superminhash(np.concatenate([sets[i] for i in full]),
                                       np.repeat(np.arange(len(full)), lens[full]), len(full), slots)
                    for i, row, x in zip(full, bands(sig, rows), sig.astype(np.uint8)):
                        keys[i], short[i] = row, x.tobytes()
                dig = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(lens, pa.int64()), pa.array(dig[:, 0].copy()),
                     pa.array(dig[:, 1].copy()), pa.array(keys, pa.list_(pa.int64())), pa.array(short, pa.binary())],
                    names=["doc_id", "n_shingles", "d1", "d2", "bands", "sig"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_shingles long, d1 long, d2 long, bands array<long>, sig binary")


def verified(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT, k: int = K) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach ``percent``: intersection
    against union, in whole numbers.  Texts travel, not sets: they are smaller."""
    # pairs grow with the documents: joined by shuffle at every size
    left = pairs.hint("merge").join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, None
        for batch in batches:
            ok = []
            a, b, ta, tb = (batch.column(batch.schema.get_field_index(c)) for c in ("a", "b", "ta", "tb"))
            for i in range(batch.num_rows):
                # an id whose rows hold different texts comes with each of them
                if last is None or (a[i].as_py(), ta[i].as_py()) != last:
                    last = a[i].as_py(), ta[i].as_py()
                    kept = shingles(last[1], k)
                y = shingles(tb[i].as_py(), k)
                if 100 * min(len(kept), len(y)) < percent * max(len(kept), len(y)):
                    ok.append(False)
                    continue
                same = len(np.intersect1d(kept, y, assume_unique=True))
                ok.append(100 * same >= percent * (len(kept) + len(y) - same))
            yield pa.RecordBatch.from_arrays([a.filter(pa.array(ok)), b.filter(pa.array(ok))], names=["a", "b"])

    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def resembling(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures agree in ``ALIKE`` of their slots."""
    both = (pairs.hint("merge").join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a")
            .join(sigs.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("sa", "sb"))
                ok = pa.array((x == y).sum(1) >= ALIKE * x.shape[1])
                yield pa.RecordBatch.from_arrays([batch["a"].filter(ok), batch["b"].filter(ok)], names=["a", "b"])

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def groups(docs: DataFrame, percent: int = PERCENT, k: int = K, slots: int = SLOTS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``
    (doc_id whole number, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sigs = cut_lineage(signatures(docs, k, slots, rows), "signatures")
    part = sigs.where("n_shingles > 0 and doc_id is not null")
    # a node is a distinct set, named by its smallest id; an id whose rows hold different sets joins them
    nodes = part.groupBy("d1", "d2").agg(F.min("doc_id").alias("node"))
    member = part.select("doc_id", "d1", "d2").join(nodes, ["d1", "d2"]).select("doc_id", "node").distinct()
    member = cut_lineage(member, "members")
    reps = (part.withColumnRenamed("doc_id", "node").join(nodes, ["d1", "d2", "node"], "left_semi")
            .dropDuplicates(["d1", "d2", "node"]))
    links = linked(cut_lineage(buckets_of(reps), "buckets"), reps.select("node", "sig"),
                   docs.where(F.col("doc_id").isNotNull()).withColumnRenamed("doc_id", "node"), percent, k)
    same_id = member.where("doc_id <> node").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    comp = components(links.unionByName(same_id))
    return (sigs.select("doc_id", "n_shingles")
            .join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .withColumn("component_id", F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id"))
                        .otherwise(F.col("doc_id")))
            .select("doc_id", "n_shingles", "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))


def buckets_of(reps: DataFrame) -> DataFrame:
    """(key, node, n, weight) of the buckets with two members or more, one for each
    set of members; ``weight``: the sizes of all the node's buckets together."""
    keyed = reps.select("node", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    size = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("node")).alias("s1"),
                                    F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("s2")).where("size > 1")
    size = cut_lineage(size, "sizes")
    one = size.groupBy("size", "s1", "s2").agg(F.min("key").alias("key")).select("key")
    live = cut_lineage(keyed.join(size.select("key", "size"), "key"), "keyed")
    weight = live.groupBy("node").agg(F.sum("size").alias("weight"))
    return live.join(one, "key", "left_semi").drop("size").join(weight, "node")


def linked(buckets: DataFrame, sigs: DataFrame, texts: DataFrame, percent: int, k: int) -> DataFrame:
    """Links (a, b) that connect what all checked pairs within buckets (key,
    node, n, weight) would connect.

    ``STARS`` rounds check the members of every open bucket against a centre.  A
    bucket is open while its members are of several groups; groups are kept from
    round to round, and new links join groups, not documents.  What is still open
    is compared whole, by signature, in blocks of bounded size (``alike``).
    """
    found = buckets.sparkSession.createDataFrame([], "a long, b long")
    live, used, comp = buckets.withColumn("comp", F.col("node")), None, None
    for _ in range(STARS):
        ahead = live if used is None else live.join(used, ["key", "node"], "left_anti")
        first = F.max(F.struct("weight", (-F.col("node")).alias("least"), "comp", "n"))
        centres = ahead.groupBy("key").agg(first.alias("c"))
        centres = cut_lineage(centres.select("key", (-F.col("c.least")).alias("c"), F.col("c.comp").alias("cc"), F.col("c.n").alias("cn")), "centres")
        # a link needs sizes within the threshold of each other
        pairs = (live.join(centres, "key").where("node <> c and comp <> cc")
                 .where(100 * F.least("n", "cn") >= percent * F.greatest("n", "cn"))
                 .select(F.least("c", "node").alias("a"), F.greatest("c", "node").alias("b")).distinct())
        near = cut_lineage(resembling(pairs, sigs), "near")
        links = cut_lineage(verified(near, texts, percent, k), "links")
        found = found.unionByName(links)
        comp = cut_lineage(joined(comp, links), "groups")
        used = centres.select("key", F.col("c").alias("node"))
        now = live.drop("comp").join(comp, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")
        open_ = now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
        live = cut_lineage(now.join(open_, "key", "left_semi"), "live")
    return found.unionByName(cut_lineage(alike(live, sigs, texts, percent, k), "links"))


CELL = ["key", "i", "j", "block", "node", "n", "comp", "sig"]


def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of equal (key, i, j) in sorted rows."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        at = np.stack([batch[c].to_numpy() for c in ("key", "i", "j")])
        cuts = [0, *(np.flatnonzero((at[:, 1:] != at[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
        for x, y in zip(cuts, cuts[1:]):
            if held and tuple(at[:, x]) != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(x, y - x))
            last = tuple(at[:, x])
    if held:
        yield pa.Table.from_batches(held)


def candidates(cell: pa.Table, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, later rows) of a cell that may link: other groups, fitting sizes, and
    signatures that agree."""
    block, n, comp = (cell[c].to_numpy() for c in ("block", "n", "comp"))
    x = np.frombuffer(b"".join(cell["sig"].to_pylist()), np.uint8).reshape(len(n), -1)
    apart = cell["i"][0].as_py() != cell["j"][0].as_py()
    for r in range(len(n) - 1):
        rest = slice(r + 1, None)
        ok = (comp[rest] != comp[r]) & (100 * np.minimum(n[rest], n[r]) >= percent * np.maximum(n[rest], n[r]))
        if apart:
            ok &= block[rest] != block[r]
        at = np.flatnonzero(ok) + r + 1
        if len(at):
            at = at[(x[at] == x[r]).sum(1) >= ALIKE * x.shape[1]]
            if len(at):
                yield r, at


def alike(live: DataFrame, sigs: DataFrame, texts: DataFrame, percent: int, k: int) -> DataFrame:
    """Links (a, b) between groups within a bucket, enough to connect what all
    its links connect.

    A bucket is cut into blocks of about ``BLOCK`` members; a cell holds two
    blocks, so no task holds a bucket.  Cells are runs of sorted rows, many to a
    task.  A first pass keeps the members that may link with any other of their
    cell; these meet their texts, and a cell gives out only links that join two of
    its groups, never its pairs."""
    blocks = live.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
    rows = live.select("key", "node", "n", "comp").join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "n", "comp")

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in cells(batches):
            keep = np.zeros(len(cell), bool)
            for r, at in candidates(cell, percent):
                keep[r] = keep[at] = True
            if keep.any():
                yield from cell.filter(pa.array(keep)).combine_chunks().to_batches()

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in cells(batches):
            node, comp = cell["node"].to_numpy(), cell["comp"].to_pylist()
            sets = [shingles(t, k) for t in cell["text"].to_pylist()]
            up: dict[int, int] = {}

            def root(c: int) -> int:
                while c in up:
                    c = up[c]
                return c

            a, b = [], []
            for r, at in candidates(cell, percent):
                for o in at.tolist():
                    x, y = root(comp[r]), root(comp[o])
                    if x != y:
                        same = len(np.intersect1d(sets[r], sets[o], assume_unique=True))
                        if 100 * same >= percent * (len(sets[r]) + len(sets[o]) - same):
                            up[x] = y
                            a.append(min(node[r], node[o]))
                            b.append(max(node[r], node[o]))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    shape = "key long, i int, j int, block int, node long, n long, comp long, sig binary"
    few = cut_lineage(dealt(rows.join(sigs, "node").select(*CELL)).mapInArrow(some, shape), "cells")
    return dealt(few.join(texts.hint("merge"), "node").select(*CELL, "text")).mapInArrow(links, "a long, b long")


def joined(comp: DataFrame | None, links: DataFrame) -> DataFrame:
    """Groups (node, component) after new links: the links join the groups of
    their ends, and only groups are gone through again."""
    if comp is None:
        return components(links)
    c = [comp.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")) for x in ("a", "b")]
    ends = (links.join(c[0], "a", "left").join(c[1], "b", "left")
            .select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb")))
    ends = cut_lineage(ends, "ends")
    up = components(ends.where("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b"))).toDF("old", "new")
    every = comp.unionByName(ends.select(F.col("a").alias("node"), F.col("ca").alias("component"))).unionByName(
        ends.select(F.col("b").alias("node"), F.col("cb").alias("component"))).distinct()
    return every.join(up, F.col("component") == F.col("old"), "left").select("node", F.coalesce("new", "component").alias("component"))
