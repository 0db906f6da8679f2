"""Benchmark decontamination by passages, with their latent semantic cosine.

1. Documents become word numbers of the benchmark's vocabulary (-1 for other
   words, which cannot add to a product with a benchmark item), written once.
2. Passages of ``WORDS`` words give document frequencies; their TF-IDF matrix, with
   columns scaled to one length, gets a randomised SVD: every task multiplies its
   own rows, tables of vocabulary size are added up by Spark, all documents take
   part.
3. Every sliding passage and every item's passages are folded in on the leading right
   singular vectors, each divided by its eigenvalue, so directions that very many
   passages share (a language, common words) count least.  All pairs with a latent cosine
   of ``LATENT`` or more are candidates, however little of the item the passage holds.
   Holding ``OVERLAP`` of the TF-IDF weight of an item's passage, found exactly from lists
   of the items' weightier words, is enough by itself, whatever the cosine.
4. A candidate is confirmed by the longest common subsequence of the item with
   the words around the passage, weighted by IDF: ``NEAR`` of the item's weight
   alone, or ``PARAPHRASE`` of it with ``ANSWER`` of the weight of the answer (the
   item's last sentence).  It is not computed where the item's words that stand around
   the passage, in whatever order, weigh too little for that: those pairs fail it.

Defined results: null, empty or wordless texts and items match nothing; an item
longer than a passage is looked for by each of its passages; repeated rows get
equal results, repeated items one; an empty benchmark or table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penmark.llm.common import row_key
from penmark.session import cut_lineage

WORD = re.compile(r"\w+")
#: WORD over the characters that one byte holds: others become blanks.
LATIN = bytes(c if WORD.match(chr(c)) else 32 for c in range(256))
SENTENCE_END = re.compile(r"[.!?]+\s*")
BLOCK = 12
WORDS = 3 * BLOCK
RANK, EXTRA = 64, 8
OVERLAP = 0.3
LATENT = 0.5
#: Weight of the commonest words that lists of passages, and of whole items, may leave to the exact count.
COMMON, COMMON_ITEM = 0.1, 0.2
NEAR, PARAPHRASE, ANSWER = 0.6, 0.4, 0.6
#: Benchmark text that is handled, and broadcast, at a time.
BENCHMARK_BYTES = 2 << 20
_SLAB = 256


class Items:
    """A block of benchmark items as word numbers, passages and answers."""

    def __init__(self, rows: list[tuple]):
        self.vocab: dict[str, int] = {}
        self.ids, self.words, self.answers = [], [], []
        self.passages: list[tuple[int, np.ndarray]] = []
        for item, text in sorted(set(rows)):
            words = [self.vocab.setdefault(w, len(self.vocab)) for w in WORD.findall(text.lower())]
            if not words:
                continue
            last = [s for s in SENTENCE_END.split(text.lower()) if WORD.search(s)][-1]
            n = len(WORD.findall(last))
            i = len(self.ids)
            self.ids.append(item)
            self.words.append(np.array(words, np.int32))
            self.answers.append(len(words) - n if n < len(words) else 2 * len(words) // 3)
            parts = -(-len(words) // WORDS)
            self.passages += [(i, p) for p in np.array_split(self.words[-1], parts)]

    def weights(self, idf: np.ndarray) -> np.ndarray:
        """TF-IDF of the items' passages, unit length, passages x vocabulary."""
        q = np.zeros((len(self.passages), len(self.vocab)), np.float32)
        for r, (_, p) in enumerate(self.passages):
            np.add.at(q[r], p, idf[p])
        return q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-9)

    def whole(self, idf: np.ndarray) -> np.ndarray:
        """Share of the items' IDF weight that each word holds, items x vocabulary."""
        q = np.zeros((len(self.ids), len(self.vocab)))
        for r, w in enumerate(self.words):
            np.add.at(q[r], w, idf[w])
        return q / np.maximum(q.sum(1, keepdims=True), 1e-9)


def numbered_words(vocab: dict[str, int]):
    """text -> its words' numbers; a text of Latin characters is cut as bytes, several times as fast."""
    get = vocab.get
    latin = {w.encode("latin-1"): n for w, n in vocab.items() if max(w, default="") <= "\xff"}.get

    def numbers(text: str) -> np.ndarray:
        text = text.lower()
        try:
            words, of = text.encode("latin-1").translate(LATIN).split(), latin
        except UnicodeEncodeError:
            words, of = WORD.findall(text), get
        return np.fromiter(map(of, words, repeat(-1)), np.int32, len(words))

    return numbers


def tokens(docs: DataFrame, vocab: dict[str, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(__pm_id, __pm_h, doc_id, n, ids): word numbers as 32-bit bytes, all words of a text."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = numbered_words(shared.value)
        for b in batches:
            out = [numbers(t or "").tobytes() for t in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(out, pa.binary())],
                                             names=["__pm_id", "__pm_h", "doc_id", "ids"])

    return docs.select(*row_key(id_col, text_col), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"__pm_id string, __pm_h long, doc_id {kind}, ids binary")


def passages(ids: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the non-overlapping passages that words (with their document,
    ascending) fall in, and how many passages there are; known words only."""
    first = np.concatenate(([0], np.flatnonzero(np.diff(owner)) + 1))
    at = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
    new = at % WORDS == 0
    return np.cumsum(new) - 1, int(new.sum())


def summed(tok: DataFrame, width: int, height: int, part) -> np.ndarray:
    """Sum over all documents of ``part(ids, passage, n_passages)``, an array of
    ``height`` x ``width``.

    Tasks emit their sums in slabs of rows; two grouped steps add them, the first
    salted by task, so no group grows with the number of tasks alone.
    """
    slabs = -(-height // _SLAB)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        total = np.zeros((slabs * _SLAB, width))
        for b in batches:
            for lo in range(0, b.num_rows, 200):
                col = b.column(0).slice(lo, 200)
                arrays = [np.frombuffer(x.as_buffer(), np.int32) for x in col if x.as_buffer().size]
                if arrays:
                    ids = np.concatenate(arrays)
                    owner = np.repeat(np.arange(len(arrays)), [len(a) for a in arrays])
                    passage, n = passages(ids, owner)
                    total[:height] += part(ids[ids >= 0], passage[ids >= 0], n)
        salt = TaskContext.get().partitionId() % 32
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(slabs), pa.int32()), pa.array([salt] * slabs, pa.int32()),
             pa.array([s.tobytes() for s in np.split(total, slabs)], pa.binary())], names=["slab", "salt", "data"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        s = np.zeros(_SLAB * width)
        for x in pdf["data"]:
            s += np.frombuffer(x)
        return pdf.iloc[:1].assign(data=[s.tobytes()])

    schema = "slab int, salt int, data binary"
    rows = (tok.select("ids").mapInArrow(local, schema).groupBy("slab", "salt").applyInPandas(add, schema)
            .groupBy("slab").applyInPandas(add, schema).orderBy("slab").collect())
    # the vocabulary of a benchmark block bounds what arrives here
    return np.concatenate([np.frombuffer(r["data"]).reshape(_SLAB, width) for r in rows])[:height]


def passage_frequency(tok: DataFrame, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(passages that hold each word, inverse frequency) over all documents."""
    def part(ids, passage, n):
        pair = np.unique(ids.astype(np.int64) * max(1, n) + passage)
        out = np.bincount(pair // max(1, n), minlength=n_words + 1).astype(float)
        out[n_words] = n
        return out[:, None]

    got = summed(tok, 1, n_words + 1, part)[:, 0]
    return got[:-1], np.log((1 + got[-1]) / (1 + got[:-1])) + 0.02


def singular_vectors(tok: DataFrame, frequency: np.ndarray, rank: int = RANK, extra: int = EXTRA,
                     seed: int = 9) -> np.ndarray:
    """Leading right singular vectors (vocabulary x rank) of the passages, each
    divided by its eigenvalue.

    A column of TF-IDF scaled to one length is a word's counts over the square
    root of its passages.  Randomised: A'A is applied to a random block, the
    result made orthonormal, and A'A applied once more; the small product's
    eigenvectors turn the basis.
    """
    n_words = len(frequency)
    scale = 1 / np.sqrt(frequency + 1)
    width = min(rank + extra, n_words)
    sc = tok.sparkSession.sparkContext

    def apply(block: np.ndarray) -> np.ndarray:
        # a row for each of the block's columns, so that sums run along memory
        shared = sc.broadcast((scale.astype(np.float32), np.ascontiguousarray((block * scale[:, None]).T, np.float32)))

        def part(ids, passage, n):
            w, g = shared.value
            out = np.zeros((n_words, width))
            if len(ids):
                first = np.concatenate(([0], np.flatnonzero(np.diff(passage)) + 1))
                row = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(ids))))
                order = np.argsort(ids, kind="stable")
                row, term = row[order], ids[order]
                start = np.concatenate(([0], np.flatnonzero(np.diff(term)) + 1))
                got = np.empty((width, len(start)), np.float32)
                for c in range(width):
                    y = np.add.reduceat(g[c].take(ids), first)               # A block, a number per passage
                    got[c] = np.add.reduceat(y.take(row), start)
                t = term[start]
                out[t] = got.T * w[t][:, None]
            return out

        return summed(tok, width, n_words, part)

    q, _ = np.linalg.qr(apply(np.random.default_rng(seed).normal(size=(n_words, width))))
    t = q.T @ apply(q)
    value, vec = np.linalg.eigh((t + t.T) / 2)
    keep = min(rank, width)
    value = value[::-1][:keep]
    # directions that hardly any passage has must not count most: no divisor under the median
    real = value[value > 1e-6 * max(value.max(), 1e-12)]
    value = np.maximum(value, np.median(real) if len(real) else 1.0)
    return q @ vec[:, ::-1][:, :keep] / value


def common_subsequence(item: np.ndarray, text: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Which words of ``item`` are in its heaviest common subsequence with ``text``."""
    n, m = len(item), len(text)
    best = np.zeros((n + 1, m + 1))
    for i in range(n):
        take = np.where(text == item[i], best[i, :-1] + weight[i], 0)
        best[i + 1, 1:] = np.maximum.accumulate(np.maximum(take, best[i, 1:]))
    used, i, j = np.zeros(n, bool), n, m
    while i and j:
        if best[i, j] == best[i - 1, j]:
            i -= 1
        elif best[i, j] == best[i, j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            used[i] = True
    return used


def accepted(share: float, part: float) -> bool:
    return share >= NEAR or (share >= PARAPHRASE and part >= ANSWER)


def confirm(words: np.ndarray, at: int, item: np.ndarray, answer: int, idf: np.ndarray, over: float = -1) -> tuple[float, float, bool]:
    """(share of the item's weight, of the answer's, verdict) for a document's
    words around position ``at``; zero shares where no order of those words would do,
    or give a share ``over`` that of a better place."""
    region = words[max(0, at - len(item)):at + WORDS + len(item)]
    region = region[region >= 0]
    w = idf[item]
    here = np.zeros(len(idf), bool)
    here[region] = True
    most = w * here[item]
    share = most.sum() / w.sum() + 1e-9
    if share <= max(over, PARAPHRASE) or not accepted(share, most[answer:].sum() / w[answer:].sum() + 1e-9):
        return 0.0, 0.0, False
    used = common_subsequence(item, region, w)
    share = float(w[used].sum() / w.sum())
    part = float(w[answer:][used[answer:]].sum() / w[answer:].sum())
    return share, part, accepted(share, part)


class Lists:
    """Item passages (or items) by word: each stands in the list of each of its words
    but the commonest ones of ``common`` of its weight together.  A stretch of
    words can hold ``need`` of it only if its listed words hold ``least``."""

    def __init__(self, weights: np.ndarray, idf: np.ndarray, need: float, common: float):
        order = np.argsort(idf, kind="stable")
        listed, self.least = weights > 0, np.full(len(weights), need - 1e-4)
        for r, w in enumerate(weights):
            o = order[listed[r, order]]
            left = o[np.cumsum(w[o]) <= common]
            listed[r, left] = False
            self.least[r] -= w[left].sum()
        word, self.passage = np.nonzero(listed.T)
        self.weight = weights[self.passage, word]
        self.start = np.searchsorted(word, np.arange(len(idf) + 1))

    def sums(self, ids: np.ndarray, block: np.ndarray, blocks: int) -> np.ndarray:
        """Weight of each block's listed words, repeats included, blocks x passages."""
        n = self.start[ids + 1] - self.start[ids]
        at = np.repeat(self.start[ids] - np.cumsum(n) + n, n) + np.arange(n.sum())
        width = len(self.least)
        return np.bincount(np.repeat(block, n) * width + self.passage[at], self.weight[at],
                           minlength=blocks * width).reshape(blocks, width)


def search(tok: DataFrame, items: Items, idf: np.ndarray, vectors: np.ndarray, item_type: str) -> DataFrame:
    """(__pm_id, __pm_h, doc_id, item_id, word, cosine, lcs, answer): confirmed matches, the
    best passage for each document and item."""
    q = items.weights(idf)
    latent = q @ vectors.astype(np.float32)
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
    near_items = Region(items, idf)
    shared = tok.sparkSession.sparkContext.broadcast(
        (items, idf, q * q, Lists(q * q, idf, OVERLAP, COMMON), near_items, latent.astype(np.float32),
         np.append(vectors * idf[:, None], np.zeros((1, vectors.shape[1])), 0).astype(np.float32)))
    kind = tok.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        it, w, squared, lists, regions, target, table = shared.value
        of = [i for i, _ in it.passages]
        for b in batches:
            rows = []
            for docs, start, words in stretches([np.frombuffer(x.as_buffer(), np.int32) for x in b.column(3)]):
                best: dict[tuple, tuple] = {}
                begin = start.tolist()
                for place, p in candidates(words, edges(docs, start, len(words)), target, table, squared, lists, regions):
                    k = bisect_right(begin, place) - 1
                    d, at, i = docs[k][0], place - begin[k] + docs[k][2], of[p]
                    over = best[d, i][2] if (d, i) in best else -1
                    if over > 0.999:
                        continue
                    share, part, ok = confirm(docs[k][1], at, it.words[i], it.answers[i], w, over)
                    if ok and ((d, i) not in best or share > best[d, i][2]):
                        best[d, i] = (at, latent_cosine(words, place, target[p], table), share, part)
                rows += [(d, i, *v) for (d, i), v in best.items()]
            # a long document comes in several stretches: its best passage for each item
            top = {}
            for r in rows:
                if r[:2] not in top or r[4] > top[r[:2]][4]:
                    top[r[:2]] = r
            rows = [(r[0], it.ids[r[1]], *r[2:]) for r in sorted(top.values())]
            cols = list(zip(*rows)) or [()] * 6
            take = pa.array(cols[0], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c).take(take) for c in range(3)), pa.array(cols[1]).cast(b_type), pa.array(cols[2], pa.int64()),
                 *(pa.array(c, pa.float64()) for c in cols[3:])],
                names=["__pm_id", "__pm_h", "doc_id", "item_id", "word", "cosine", "lcs", "answer"])

    b_type = pa.string() if item_type == "string" else pa.int64()
    return tok.select("__pm_id", "__pm_h", "doc_id", "ids").mapInArrow(
        run, f"__pm_id string, __pm_h long, doc_id {kind}, item_id {item_type}, word long, cosine double, lcs double, answer double")


def stretches(docs: list[np.ndarray], most: int = 400 * BLOCK):
    """Documents' words side by side, ``most`` or so at a time: ((document, its
    words, first word) of each, where each starts, the words).  Blank blocks
    part them, so no passage spans two; a long document goes on in the next
    stretch, with a passage's overlap."""
    gap = WORDS - BLOCK
    part, start, words, size = [], [], [], 0
    for d, x in enumerate(docs):
        for lo in range(0, len(x), most):
            piece = x[lo:lo + most + gap]
            n = -(-len(piece) // BLOCK) * BLOCK + gap
            padded = np.full(n, -1, np.int32)
            padded[:len(piece)] = piece
            part.append((d, x, lo))
            start.append(size)
            words.append(padded)
            size += n
            if size >= most:
                yield part, np.array(start), np.concatenate(words)
                part, start, words, size = [], [], [], 0
    if part:
        yield part, np.array(start), np.concatenate(words)


def edges(docs: list[tuple], start: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each block of a stretch, how many blocks of its document's words lie before it
    and from it on in the stretch; very many where the document begins or ends here."""
    blocks = -(-size // BLOCK)
    begin = start // BLOCK
    piece = np.searchsorted(begin, np.arange(blocks), "right") - 1
    far = 1 << 40
    ahead = np.array([far if lo == 0 else 0 for _, _, lo in docs])
    # a piece that its document goes on from ends before the blank blocks that follow it
    end = np.append(begin[1:], blocks) - (WORDS - BLOCK) // BLOCK
    cut = np.array([lo + (e - b) * BLOCK < len(x) for (_, x, lo), b, e in zip(docs, begin, end)])
    at = np.arange(blocks)
    return at - begin[piece] + ahead[piece], np.where(cut, end, far)[piece] - at


class Region:
    """Which items the words around a passage can make ``confirm`` accept at all: those
    with ``PARAPHRASE`` of their weight there, repeats included, blocks not halved."""

    def __init__(self, items: Items, idf: np.ndarray):
        self.lists = Lists(items.whole(idf), idf, PARAPHRASE, COMMON_ITEM)
        self.reach = np.array([-(-len(w) // BLOCK) for w in items.words], np.int64)
        self.of = np.array([i for i, _ in items.passages], np.int64)

    def possible(self, ids: np.ndarray, block: np.ndarray, blocks: int, around: tuple[np.ndarray, np.ndarray],
                 at: np.ndarray, passage: np.ndarray) -> np.ndarray:
        """For pairs of a first block and an item passage; one whose region goes on outside the stretch is possible."""
        total = np.zeros((blocks + 1, len(self.reach)))
        np.cumsum(self.lists.sums(ids, block, blocks), 0, out=total[1:])
        item = self.of.take(passage)
        reach = self.reach.take(item)
        last, first = np.minimum(at + WORDS // BLOCK + reach, blocks), np.maximum(at - reach, 0)
        total = total.ravel()
        ok = total.take(last * len(self.reach) + item) - total.take(first * len(self.reach) + item) >= self.lists.least.take(item)
        ok |= around[0].take(at) < reach
        ok |= around[1].take(at) < reach + WORDS // BLOCK
        return ok


def latent_cosine(words: np.ndarray, at: int, target: np.ndarray, table: np.ndarray) -> float:
    """Of the passage at a word with an item passage."""
    t = np.sort(words[at:at + WORDS])
    p = table[t[t >= 0]].sum(0)
    return float(p @ target / max(np.sqrt(p @ p), 1e-9))


def candidates(words: np.ndarray, around: tuple[np.ndarray, np.ndarray], target: np.ndarray, table: np.ndarray,
               squared: np.ndarray, lists: Lists, regions: Region):
    """(first word, item passage) of all sliding passages that hold
    OVERLAP of an item passage's TF-IDF weight, then of all others that have a cosine of
    LATENT with it, so of equally good passages the former are reported.  Left out are only
    pairs that ``confirm`` cannot accept, by the words around the passage."""
    known = np.flatnonzero(words >= 0)
    blocks = -(-len(words) // BLOCK)
    if not len(known):
        return
    ids, block = words[known], known // BLOCK
    held = np.full((blocks + 2) * BLOCK, -1, np.int64)
    held[:len(words)] = words
    # a passage's vector is the sum of its blocks', a block's that of its words'; other words take the last row, zeros
    part = np.zeros((blocks + 2, table.shape[1]), np.float32)
    for column in held.reshape(-1, BLOCK).T:
        part += table.take(column, 0, mode="wrap")
    folded = part[:-2] + part[1:-1]
    folded += part[2:]
    folded /= np.maximum(np.sqrt(np.einsum("ij,ij->i", folded, folded)), 1e-9)[:, None]
    cos = folded @ target.T
    # these sums round otherwise than a passage's own, which decides
    w, i = np.divmod(np.flatnonzero(cos >= LATENT - 1e-4), len(target))
    ok = regions.possible(ids, block, blocks, around, w, i)
    near = dict.fromkeys(zip(w[ok].tolist(), i[ok].tolist()))

    sums = lists.sums(ids, block, blocks + 2)
    held_by = sums[:-2] + sums[1:-1]
    held_by += sums[2:]
    win, item = np.divmod(np.flatnonzero(held_by >= lists.least), len(target))
    own, row = np.unique(win, return_inverse=True)
    t = np.sort(held[own[:, None] * BLOCK + np.arange(WORDS)], 1)
    new = t >= 0
    new[:, 1:] &= t[:, 1:] != t[:, :-1]
    for lo in range(0, len(win), 20_000):
        r, i = row[lo:lo + 20_000], item[lo:lo + 20_000]
        share = np.where(new[r], squared[i[:, None], np.maximum(t[r], 0)], 0).sum(1)
        for k in np.flatnonzero(share >= OVERLAP):
            pair = int(own[r[k]]), int(i[k])
            near.pop(pair, None)
            yield pair[0] * BLOCK, pair[1]
    for w, i in near:
        if cos[w, i] >= LATENT + 1e-4 or latent_cosine(words, w * BLOCK, target[i], table) >= LATENT:
            yield w * BLOCK, i


def find(docs: DataFrame, benchmark: DataFrame, item_col: str = "item_id", bench_col: str = "text") -> DataFrame:
    """Confirmed (document, item) matches over all items, a block of benchmark
    text of bounded size at a time."""
    bench = benchmark.select(F.col(item_col).alias("item_id"), F.col(bench_col).alias("t")).where(
        F.col("item_id").isNotNull() & (F.length("t") > 0)).distinct()
    size = bench.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-size // BENCHMARK_BYTES))
    item_type = "string" if dict(benchmark.dtypes)[item_col] == "string" else "bigint"
    out = None
    for k in range(blocks):
        part = bench.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == k).collect()
        items = Items([(r["item_id"], r["t"]) for r in part])
        tok = cut_lineage(tokens(docs, items.vocab), "words")
        if not items.ids:
            items.vocab = {"": 0}
        frequency, idf = passage_frequency(tok, len(items.vocab))
        vectors = singular_vectors(tok, frequency) if items.ids else np.zeros((1, 1))
        got = cut_lineage(search(tok, items, idf, vectors, item_type), "matches")
        out = got if out is None else out.unionByName(got)
    return out
