"""Phrase collocations by set-oriented mining of sorted occurrence relations.

R1 holds every occurrence (document, place, word) of a frequent word, sorted by
place; places go up by one inside a piece and skip one between pieces, so
neighbours are rows of adjacent place.  It is written clustered, a row for each
document with its occurrences in order, so that R_k+1, the merge of R_k with
itself one place on, needs neither an exchange nor a sort: a phrase of k + 1
words begins where phrases of k words begin at this place and at the next.  R_k+1
is grouped and counted by Spark (counts are combined in each task before they
are exchanged, so a phrase with a third of all occurrences is one row a task),
R_k+1 is semi-joined with its frequent phrases and written before it is extended.

Words are numbered by their place in the sorted hashes of the frequent words,
where these are no more than ``MAX_WORDS``; beyond, their hash stands for them.
The hash's seed is changed until no two words of the corpus share one, so counts
are exact.  The semi-join goes through a bitmap of fixed size: a false hit keeps
an occurrence that counts for nothing, so results do not depend on it.

A text is lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and
those into words ``[^\\x20\\x09]+``.  A phrase's score is the smallest over its
cuts of floor(1000000 a^2 / (l r)), in exact decimals of 38 digits (counts below
10^15); a tie goes to the shorter first part.  A phrase inside a longer frequent
one that occurs at least half as often is dropped.

Defined results: a null or empty text has no words; a null language is ``und``;
repeated rows count each time; ties of score go to the more frequent phrase, then
to the smaller one in UTF-8 byte order; a language without frequent phrases has no
rows, an empty table none.  Very long texts are read in windows cut between
words.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from penmark.llm.common import STEP_BYTES, mix64
from penmark.operators.joins import MAX_BROADCAST_BYTES, small_table
from penmark.session import cut_lineage

#: Ranks are found first within this many parts of a language.
SALT = 64
EXACT = "decimal(18,0)"
#: Frequent words that a task looks up by number (8 bytes each), bits of a semi-join's bitmap.
MAX_WORDS = MAX_BROADCAST_BYTES // 8
BITMAP_BITS = 26
SEEDS = 32
#: Bytes of text whose words are combined before Spark counts them; documents merged at once.
COUNT_BYTES = 2 * STEP_BYTES
MERGE_ROWS = 256

BLANK, CUT = 1, 2
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = BLANK
KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = CUT
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ODD = np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------------------- words

def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """ODD^i and ODD^-i modulo 2^64 for i up to n."""
    up, down = np.full(n + 1, ODD), np.full(n + 1, np.uint64(pow(int(ODD), -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


class Words:
    """Words of a run of texts: where they begin and end in its bytes, places, hashes."""

    def __init__(self, seed: int):
        self.byte = mix64(np.arange(256, dtype=np.uint64) + np.uint64(1 + 256 * seed))[LOWER]
        self.up, self.down = powers(STEP_BYTES)

    def windows(self, kind: np.ndarray) -> Iterator[tuple[int, int]]:
        """Cuts of at most ``STEP_BYTES`` at the end of a word; a longer word is whole."""
        a, n = 0, len(kind)
        while a < n:
            b = min(n, a + STEP_BYTES)
            if b < n:
                back = np.flatnonzero(kind[a:b])
                if len(back):
                    b = a + int(back[-1]) + 1
                else:
                    on = np.flatnonzero(kind[b:])
                    b = b + int(on[0]) + 1 if len(on) else n
            yield a, b
            a = b

    def split(self, data: np.ndarray):
        """(start, end, piece, hash) of the words of ``data``."""
        kind = KIND[data]
        out, pieces = [], 0
        for a, b in self.windows(kind):
            part = kind[a:b]
            inside = np.concatenate([[False], part == 0, [False]])
            edge = np.flatnonzero(inside[1:] != inside[:-1])
            start, end = edge[::2], edge[1::2]
            if len(self.up) <= b - a:
                self.up, self.down = powers(b - a)
            summed = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.byte[data[a:b]] * self.up[:b - a], dtype=np.uint64)])
            h = (summed[end] - summed[start]) * self.down[start]
            cuts = np.flatnonzero(part == CUT)
            out.append((start + a, end + a, np.searchsorted(cuts, start) + pieces, h))
            pieces += len(cuts)
        return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)]

    def of_texts(self, texts: list[bytes], langs: np.ndarray):
        """(data, start, end, text, place, hash) of the words of several texts;
        ``langs`` holds a number for each text's language."""
        data = np.frombuffer(b"\n".join(texts), np.uint8)
        start, end, piece, h = self.split(data)
        begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        text = np.searchsorted(begins, start, side="right") - 1
        # one place a word, one more between pieces
        place = np.arange(len(start)) + piece
        return data, start, end, text, place, mix64(h ^ langs[text])


def lang_hash(langs: list[str], seed: int) -> np.ndarray:
    """A number for each text's language, the same in every task."""
    of = {}
    for g in set(langs):
        h = seed + 1
        for b in g.encode():
            h = int(mix64(np.uint64((h * 257 + b) & (2**64 - 1))))
        of[g] = h
    return np.array([of[g] for g in langs], np.uint64)


def text_runs(batch: pa.RecordBatch, seed: int, limit: int = STEP_BYTES):
    """Runs of a batch's texts of about ``limit`` bytes with their languages."""
    langs = batch["lang"].to_pylist()
    texts = batch["text"].cast(pa.binary())
    ends = np.cumsum(pa.compute.binary_length(texts).to_numpy())
    a = 0
    while a < len(langs):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + limit, side="right")))
        yield texts[a:b].to_pylist(), langs[a:b], lang_hash(langs[a:b], seed)
        a = b


def unlike(low: np.ndarray, start: np.ndarray, end: np.ndarray, like: np.ndarray) -> np.ndarray:
    """Words (as indices) whose bytes differ from those of the word ``like`` them,
    compared eight at a time."""
    padded = np.concatenate([low, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(low) + 1,), "<u8", padded.data, strides=(1,))
    size = end - start
    bad = size != size[like]
    at, to = np.flatnonzero(~bad), 0
    while len(at):
        left = np.minimum(size[at] - to, 8).astype(np.uint64)
        mask = np.where(left == 8, ~np.uint64(0), (np.uint64(1) << (left * np.uint64(8))) - np.uint64(1))
        bad[at] |= (eight[start[at] + to] ^ eight[start[like[at]] + to]) & mask != 0
        to += 8
        at = at[size[at] > to]
    return np.flatnonzero(bad)


def counted(seed: int):
    """Arrow pass: (lang, word, h, f), combined over ``COUNT_BYTES`` of text.  A word
    that shares the hash of another is given out beside it."""
    def run(batches):
        words = Words(seed)
        for batch in batches:
            for texts, langs, numbers in text_runs(batch, seed, COUNT_BYTES):
                data, start, end, text, _, h = words.of_texts(texts, numbers)
                _, first, of, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
                low = LOWER[data]
                names = {g: i for i, g in enumerate(dict.fromkeys(langs))}
                lang = np.array([names[g] for g in langs])[text]
                like = first[of]
                odd = np.union1d(unlike(low, start, end, like), np.flatnonzero(lang != lang[like]))
                at = np.concatenate([first, odd])
                low = low.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(names)).take(pa.array(lang[at])),
                     pa.array([low[s:e] for s, e in zip(start[at].tolist(), end[at].tolist())], pa.binary()).cast(pa.string()),
                     pa.array(h[at].view(np.int64)), pa.array(np.concatenate([n, np.ones(len(odd), n.dtype)]))],
                    names=["lang", "word", "h", "f"])
    return run


# --------------------------------------------------------------------- relations

def phrase_hash(cols: list[np.ndarray]) -> np.ndarray:
    h = np.zeros(len(cols[0]), np.uint64)
    for c in cols:
        h = mix64(h * ODD + c.astype(np.int64).view(np.uint64))
    return h


class Bitmap:
    """Phrases that may be in a set: those of it, and few others."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def has(self, cols: list[np.ndarray]) -> np.ndarray:
        at = phrase_hash(cols) >> np.uint64(64 - BITMAP_BITS)
        return (self.bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1

    @staticmethod
    def of(found: DataFrame, keys: list[str]) -> Bitmap:
        """Set by Spark, 64 bits a row, so the driver gets the bitmap alone."""
        def run(batches):
            for b in batches:
                at = phrase_hash([b[k].to_numpy() for k in keys]) >> np.uint64(64 - BITMAP_BITS)
                yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)),
                                                  pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], names=["at", "bit"])
        t = found.select(*keys).mapInArrow(run, "at long, bit long").groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
        bits = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
        bits[t["at"].to_numpy()] = t["bits"].to_numpy().view(np.uint64)
        return Bitmap(bits)


class Numbers:
    """Word numbers of hashes: places in a sorted array, or the hash itself."""

    def __init__(self, hashes: np.ndarray | None, often: Bitmap | None):
        self.hashes, self.often = hashes, often
        self.kind = "int" if often is None else "long"

    def of(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, whether frequent) of each hash."""
        if self.often is not None:
            return h.view(np.int64), self.often.has([h.view(np.int64)])
        if not len(self.hashes):
            return np.zeros(len(h), np.int32), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return at.astype(np.int32), self.hashes[at] == h


def numbers_of(often: DataFrame, n: int) -> Numbers:
    if n > MAX_WORDS:
        return Numbers(None, Bitmap.of(often, ["h"]))
    return Numbers(np.sort(often.select("h").toArrow()["h"].to_numpy().view(np.uint64)), None)


def numbered_words(numbers: Numbers):
    """Arrow pass: the frequent words with their numbers."""
    def run(batches):
        for b in batches:
            w, _ = numbers.of(b["h"].to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([b["lang"], b["word"], b["f"], pa.array(w.astype(np.int64))], names=["lang", "word", "f", "w"])
    return run


def clustered(row: np.ndarray, n: int, values: list[tuple[np.ndarray, pa.DataType]]) -> list[pa.Array]:
    """A list for each of ``n`` rows from values in order of their row."""
    at = pa.array(np.searchsorted(row, np.arange(n + 1)).astype(np.int32))
    return [pa.ListArray.from_arrays(at, pa.array(v, t)) for v, t in values]


def steps(row: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Places as steps from the one before in their row: small numbers, packed tightly."""
    out = np.diff(place, prepend=0)
    first = np.flatnonzero(np.diff(row, prepend=-1))
    out[first] = place[first]
    return out


def first_relation(seed: int, numbers: Numbers):
    """Arrow pass: R1, a row a document: steps of place, word numbers, and whether
    a phrase begins (all do)."""
    kind = pa.int32() if numbers.kind == "int" else pa.int64()

    def run(batches):
        words = Words(seed)
        for batch in batches:
            for texts, _, langs in text_runs(batch, seed):
                _, _, _, text, place, h = words.of_texts(texts, langs)
                w, keep = numbers.of(h)
                text, place, w = text[keep], place[keep], w[keep]
                cols = clustered(text, len(texts), [(steps(text, place), pa.int32()), (w, kind), (np.ones(len(w), bool), pa.bool_())])
                yield pa.RecordBatch.from_arrays(cols, names=["step", "w", "begins"])
    return run


def slices(batches):
    for batch in batches:
        for a in range(0, batch.num_rows, MERGE_ROWS):
            yield batch.slice(a, MERGE_ROWS)


def flat(batch: pa.RecordBatch):
    """(row, place, w, begins) of a batch of a relation, flat."""
    step, w, begins = (batch[c].flatten().to_numpy(zero_copy_only=False) for c in ("step", "w", "begins"))
    size = pa.compute.list_value_length(batch["step"]).to_numpy()
    row = np.repeat(np.arange(len(size)), size)
    place = np.cumsum(step, dtype=np.int64)
    first = np.cumsum(size) - size
    before = np.where(first > 0, place[np.maximum(first, 1) - 1], 0) if len(place) else np.zeros(len(size), np.int64)
    return row, place - before[row], w, begins


def merged(batch: pa.RecordBatch, k: int):
    """R_k merged with itself one place on: (row, place, w, occurrences of k + 1
    words as the index of their first)."""
    row, place, w, begins = flat(batch)
    meets = begins[:-1] & begins[1:] & (row[1:] == row[:-1]) & (place[1:] == place[:-1] + 1)
    return row, place, w, np.flatnonzero(meets)


def phrases(k: int):
    """Arrow pass: the words of every occurrence in R_k+1."""
    def run(batches):
        for batch in slices(batches):
            _, _, w, at = merged(batch, k)
            yield pa.RecordBatch.from_arrays([pa.array(w[at + i].astype(np.int64)) for i in range(k + 1)],
                                             names=keys_of(1, k + 1))
    return run


def next_relation(k: int, often: Bitmap, kind: str):
    """Arrow pass: R_k+1 of frequent phrases; words that no phrase holds go."""
    def run(batches):
        for batch in slices(batches):
            row, place, w, at = merged(batch, k)
            at = at[often.has([w[at + i] for i in range(k + 1)])]
            begins, keep = np.zeros(len(w), bool), np.zeros(len(w), bool)
            begins[at] = True
            for i in range(k + 1):
                keep[at + i] = True
            row, place = row[keep], place[keep]
            cols = clustered(row, batch.num_rows, [(steps(row, place), pa.int32()),
                                                   (w[keep], pa.int32() if kind == "int" else pa.int64()), (begins[keep], pa.bool_())])
            yield pa.RecordBatch.from_arrays(cols, names=["step", "w", "begins"])
    return run


# ------------------------------------------------------------ scores and ranking

def keys_of(first: int, last: int) -> list[str]:
    return [f"w{i}" for i in range(first, last + 1)]


def scored(k: int, often: DataFrame, frequent: dict[int, DataFrame]) -> DataFrame:
    """Phrases of k words (w1..wk, lang, phrase, a, l, r, score)."""
    rows = frequent[k].withColumnRenamed("f", "a")
    for i in range(1, k + 1):
        rows = rows.join(often.select(F.col("w").alias(f"w{i}"), F.col("word").alias(f"word{i}"), F.col("f").alias(f"f{i}_{i}"),
                                      *([F.col("lang")] if i == 1 else [])), f"w{i}")
    for cut in range(1, k):
        for first, last in ((1, cut), (cut + 1, k)):
            if last > first:
                part = frequent[last - first + 1]
                part = part.select(*[F.col(x).alias(y) for x, y in zip(keys_of(1, last - first + 1), keys_of(first, last))],
                                   F.col("f").alias(f"f{first}_{last}"))
                rows = rows.join(part, keys_of(first, last))
    cuts = []
    for cut in range(1, k):
        a, l, r = (F.col(c).cast(EXACT) for c in ("a", f"f1_{cut}", f"f{cut + 1}_{k}"))
        rows = rows.withColumn(f"__up{cut}", a * a * F.lit(1000000).cast("decimal(7,0)")).withColumn(f"__down{cut}", l * r)
        cuts.append(F.struct(F.expr(f"__up{cut} div __down{cut}").alias("score"), F.lit(cut).alias("cut"),
                             F.col(f"f1_{cut}").alias("l"), F.col(f"f{cut + 1}_{k}").alias("r")))
    least = F.least(*cuts) if len(cuts) > 1 else cuts[0]
    return rows.select(*keys_of(1, k), "lang", F.concat_ws(" ", *[f"word{i}" for i in range(1, k + 1)]).alias("phrase"),
                       "a", least.alias("least")).select(*keys_of(1, k), "lang", "phrase", "a", "least.l", "least.r", "least.score")


def outermost(rows: DataFrame, k: int, frequent: dict[int, DataFrame], percent: int) -> DataFrame:
    """Those of k words that no longer phrase holds ``percent`` of."""
    keys = keys_of(1, k)
    parts = [long.select(*[F.col(f"w{at + i}").alias(f"w{i}") for i in range(1, k + 1)], F.col("f").alias("held"))
             for m, long in frequent.items() if m > k for at in range(m - k + 1)]
    if not parts:
        return rows
    held = parts[0]
    for p in parts[1:]:
        held = held.unionByName(p)
    held = held.groupBy(*keys).agg(F.max("held").alias("held"))
    return rows.join(held, keys, "left").where(F.col("held").isNull() | (100 * F.col("held") < percent * F.col("a"))).drop("held")


def ranked(often: DataFrame, totals: DataFrame, frequent: dict[int, DataFrame], percent: int, top: int) -> DataFrame:
    found = None
    for k in frequent:
        one = outermost(scored(k, often, frequent), k, frequent, percent).select("lang", "phrase", "a", "l", "r", "score")
        found = one if found is None else found.unionByName(one)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALT))).orderBy(*order)
    few = found.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    few = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return few.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def word_counts(docs: DataFrame) -> tuple[int, DataFrame]:
    """(seed, (lang, word, h, f)): every word's count, under a hash no two share."""
    for seed in range(SEEDS):
        parts = docs.mapInArrow(counted(seed), "lang string, word string, h long, f long")
        counts = cut_lineage(parts.groupBy("lang", "word").agg(F.sum("f").alias("f"), F.first("h").alias("h")), "words")
        if counts.groupBy("h").count().where("count > 1").isEmpty():
            return seed, counts
    raise RuntimeError("words share a hash under every seed")


def mine(docs: DataFrame, longest: int = 3, min_count: int = 10, inside_percent: int = 50, top: int = 2000,
         text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of
    2 to ``longest`` words that occur ``min_count`` times or more."""
    docs = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    seed, counts = word_counts(docs)
    totals, _ = small_table(counts.groupBy("lang").agg(F.sum("f").alias("n")))
    often = counts.where(F.col("f") >= min_count)
    numbers = numbers_of(often, often.count())
    often = cut_lineage(often.mapInArrow(numbered_words(numbers), "lang string, word string, f long, w long"), "often")
    schema = f"step array<int>, w array<{numbers.kind}>, begins array<boolean>"
    relation = cut_lineage(docs.mapInArrow(first_relation(seed, numbers), schema), "r1")
    frequent: dict[int, DataFrame] = {}
    for k in range(1, longest):
        keys = keys_of(1, k + 1)
        found = relation.mapInArrow(phrases(k), ", ".join(f"{c} long" for c in keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("f"))
        frequent[k + 1] = cut_lineage(found.where(F.col("f") >= min_count), f"f{k + 1}")
        if k + 1 < longest:
            relation = cut_lineage(relation.mapInArrow(next_relation(k, Bitmap.of(frequent[k + 1], keys), numbers.kind), schema), f"r{k + 1}")
    return ranked(often, totals, frequent, inside_percent, top)
