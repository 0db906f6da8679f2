"""Training-data operators against brute force, round trips and held-out rows."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from penmark.llm import bwtdedup, bytecnn, chunkdedup, decontam, minhash, ordinal, packing, toxicity, vptree, warc
from penmark.llm.queries import QUERIES, tokenizer_paths
from tests.conftest import SF_MID, SF_SMALL

SF_LARGE = "/root/testdata/sf0.1"

WORDS = "aa be the of and xin qué zu mor lan ti reh ost vin dul kar".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice("abcdefgh") * rng.randint(0, 2) for _ in range(n))


def frame(spark, texts, ids=None):
    """doc_id, text and extra columns whose names an operator might use itself."""
    rows = [(i if ids is None else ids[i], t, 1.0, "x", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, score double, spans string, component_id int")


def empty(spark):
    return frame(spark, []).limit(0)


# ---------------------------------------------------------------- toxicity

def test_noisy_or_finds_the_sentence():
    rng = random.Random(1)
    clean = [". ".join(prose(rng, 8) for _ in range(6)) + "." for _ in range(150)]
    toxic = []
    for _ in range(150):
        s = [prose(rng, 8) for _ in range(6)]
        s[rng.randrange(6)] += " foulword"
        toxic.append(". ".join(s) + ".")
    m = toxicity.fit(clean[:100] + toxic[:100], np.array([0] * 100 + [1] * 100))
    w = toxicity.WordWeights(m.weights)
    hits = [toxicity.locate(t, m, w) for t in toxic[100:]]
    assert sum(any("foulword" in t[s["start"]:s["start"] + s["length"]] for s in h) for t, h in zip(toxic[100:], hits)) >= 48
    assert sum(bool(toxicity.locate(t, m, w)) for t in clean[100:]) <= 2


def test_toxicity_edges(spark):
    m = toxicity.NoisyOr(np.zeros(toxicity.N_BUCKETS, np.float32), -4.0)
    df = frame(spark, [None, "", "...", "one two. three", "one two. three", "w " * 200_000])
    got = [r["toxicity"]["score"] for r in toxicity.score(df, m).orderBy("doc_id").collect()]
    assert got[:3] == [0, 0, 0] and got[3] == got[4] > 0 and len(got) == 6
    assert toxicity.score(empty(spark), m).count() == 0
    none = toxicity.train(df, spark.createDataFrame([], "doc_id long, toxic int"))
    assert max(r["toxicity"]["score"] for r in toxicity.score(df, none).collect()) < 1e-9


def test_training_sample_takes_a_text_once(spark):
    from penmark.llm.common import bounded_sample
    texts = [f"text {k}" for k in range(50)]
    df = spark.createDataFrame([(t,) for t in texts for _ in range(40)], "text string").repartition(5)
    assert bounded_sample(df.limit(0), "text", 5).count() == 0
    got = [r.text for r in bounded_sample(df, "text", 30).collect()]
    assert len(got) == len(set(got)) == 30
    assert got == [r.text for r in bounded_sample(df.distinct(), "text", 30).collect()]
    assert bounded_sample(df, "text", 99).count() == 50


# ---------------------------------------------------------------- quality

def test_ordinal_orders_grades():
    rng = random.Random(2)
    texts, grade = [], []
    for i in range(360):
        g = i % 3
        words = prose(rng, 40).split()
        for k in range((2 - g) * 8):
            words[k * 2] = words[k * 2].upper() + "!!"
        texts.append(" ".join(words))
        grade.append(g)
    m = ordinal.fit(texts[:240], np.array(grade[:240]), [0.0, 1.0, 2.0])
    assert list(m.thresholds) == sorted(m.thresholds)
    doc, ids, val = ordinal.features(texts[240:], ordinal.Shapes(ordinal.N_BUCKETS))
    up = m.tails(np.bincount(doc, weights=m.weights[ids] * val, minlength=120))
    assert (up[:, 0] >= up[:, 1]).all()
    assert np.mean(np.rint(up.sum(1)) == np.array(grade[240:])) > 0.9


def test_ordinal_edges(spark):
    df = frame(spark, [None, "", "good text here", "x" * 300_000])
    r = spark.createDataFrame([(2, 1), (None, 0), (3, None)], "doc_id long, rating int")
    m = ordinal.train(df, r, "rating")
    got = ordinal.score(df, m).collect()
    assert len(got) == 4 and all(x["quality"]["expected_grade"] == 1.0 and x["selected"] for x in got)
    assert ordinal.score(empty(spark), m).count() == 0


# ---------------------------------------------------------------- language

def test_language_held_out_accuracy(spark):
    got = QUERIES["op3_language_id_cnn"](spark, SF_MID).join(
        spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert (got.lang == got.lang_pred)[got.held_out].mean() > 0.95


def test_language_edges(spark):
    m = bytecnn.fit(["der die das und"] * 30 + ["the of and to"] * 30, ["de"] * 30 + ["en"] * 30, epochs=3)
    df = frame(spark, [None, "", "123 !!", "the of and", "the of and " * 50_000])
    got = [(r["language"]["lang_pred"], r["language"]["score"]) for r in bytecnn.predict(df, m).orderBy("doc_id").collect()]
    assert got[:3] == [("und", 0.0)] * 3 and got[3][0] == got[4][0] == "en"
    assert {r["language"]["lang_pred"] for r in bytecnn.predict(df, None).collect()} == {"und"}
    assert bytecnn.predict(empty(spark), m).count() == 0
    data = bytes(range(256)) * 5 + b"tail"
    w = bytecnn.cut(data)
    assert len(w) == 6 and w[-1].tobytes() == data[-256:]


def test_cnn_tables_equal_convolution():
    m = bytecnn.fit(["abc def"] * 8 + ["xyz uvw"] * 8, ["a"] * 8 + ["b"] * 8, epochs=1).prepare()
    x = bytecnn.cut(b"some bytes to look at")
    e = m.embed[x]
    top = [sum(e[:, j:j + 256 - len(f) + 1] @ f[j] for j in range(len(f))).max(1) for f in m.filters]
    s = np.maximum(np.concatenate(top, 1) + m.shift, 0) @ m.out + m.bias
    p = np.exp(s - s.max())
    assert np.allclose(m.windows(x), p / p.sum(), atol=1e-5)


# ---------------------------------------------------------------- packing

def check_packing(rows, docs, capacity):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_paths()[0])
    want = Counter()
    for i, text in docs:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        at, k, size = 0, 0, len(ids) % capacity or capacity
        while at < len(ids):
            want[(i, k, at, size, zlib.crc32(np.array(ids[at:at + size], "<u4").tobytes()))] += 1
            at, k, size = at + size, k + 1, capacity
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= capacity
    return len(seqs)


def test_packing_round_trip(spark):
    rng = random.Random(4)
    texts = [None, "", "a<|endoftext|>b", "½ ² 日本語  x", prose(rng, 900), prose(rng, 900), "x y", "x y"]
    texts += [prose(rng, rng.randint(1, 60)) for _ in range(120)]
    ids = list(range(len(texts)))
    ids[5], ids[7] = ids[4], None
    texts[5] = texts[4]                                      # a repeated row, and a null id
    df = frame(spark, texts, ids)
    rows = packing.pack(packing.pieces(df, *tokenizer_paths(), capacity=64), 64, rows_per_bucket=10).collect()
    n = check_packing(rows, list(zip(ids, texts)), 64)
    assert n <= 1.02 * sum(r.length for r in rows) / 64 + 1
    assert packing.pack(packing.pieces(empty(spark), *tokenizer_paths())).count() == 0


def test_packing_fills_each_sequence_first():
    def sequences(histogram):
        return max(first + to - at for _, at, to, first, _ in packing.plan(histogram, 2048))
    assert sequences({600: 4, 480: 3}) == 2
    rng = random.Random(17)
    for _ in range(200):
        h = {rng.randint(1, 2048): rng.randint(1, 9) for _ in range(rng.randint(1, 30))}
        free = []                                            # best-fit decreasing, a piece at a time
        for n in sorted((n for n, c in h.items() for _ in range(c)), reverse=True):
            k = min((k for k, f in enumerate(free) if f >= n), key=lambda k: free[k], default=None)
            if k is None:
                free.append(2048 - n)
            else:
                free[k] -= n
        assert sequences(h) == len(free)


def test_packing_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    check_packing(QUERIES["op4_bestfit_packing"](spark, SF_SMALL).collect(), docs, 2048)


# ---------------------------------------------------------------- chunk dedup

def test_chunk_dedup_resists_shifts(spark):
    rng = random.Random(5)
    p = prose(rng, 120)
    texts = [prose(rng, 60) + p + prose(rng, 60), "é" + prose(rng, 31) + p + prose(rng, 10), prose(rng, 200), None, "",
             p[:40], "long " * 100_000]
    out = {r["doc_id"]: r for r in chunkdedup.dedup(frame(spark, texts)).collect()}
    assert out[0]["__pm_removed"] == 0 and out[0]["text"] == texts[0]
    assert out[1]["__pm_removed"] > 0.75 * len(p.encode()) and p not in out[1]["text"]
    assert out[2]["text"] == texts[2] and out[3]["text"] is None and out[4]["text"] == "" and out[5]["text"] == texts[5]
    for i in (0, 1, 2):                                      # the spans give the kept text
        data, at, kept = texts[i].encode(), 0, b""
        for s in out[i]["__pm_spans"]:
            kept += data[at:s["start"]]
            at = s["start"] + s["length"]
        assert (kept + data[at:]).decode() == out[i]["text"]
    assert chunkdedup.dedup(empty(spark)).count() == 0


def test_chunk_dedup_rule_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").coalesce(1)
    got = {r["doc_id"]: r["__pm_removed"] for r in chunkdedup.dedup(docs).collect()}
    first, want, rows = {}, {}, [(r.doc_id, r.text) for r in docs.collect()]
    for i, t in rows:                                        # input order is the order of the row numbers
        data, at, spans = t.encode(), 0, []
        for e in chunkdedup.chunk_ends(data):
            if first.setdefault(data[at:e], (i, at)) != (i, at):
                spans.append((at, e - at))
            at = e
        want[i] = sum(e - s for s, e in chunkdedup.runs(spans, data, chunkdedup.MIN_RUN))
    assert got == want and sum(want.values()) > 0


def test_chunk_dedup_finds_short_passages(spark):
    """Passages of 51 words of the given documents, shared by two documents."""
    rng = random.Random(14)
    source = [r.text.split() for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect() if r.text]
    source = [w for w in source if len(w) > 100]
    passages, texts, seen = [], [], set()
    while len(passages) < 400:
        w = rng.choice(source)
        at = rng.randrange(len(w) - 51)
        words = w[at:at + 51]
        # distinct words, none of them in another passage's place
        if len(set(words)) < 30 or " ".join(words[:8]) in seen or len(" ".join(words).encode()) < 300:
            continue
        seen.update(" ".join(words[j:j + 8]) for j in range(44))
        passages.append(" ".join(words))
    for p in passages:
        for _ in range(2):
            texts.append(" ".join([*("%08x" % rng.getrandbits(32) for _ in range(rng.randint(9, 30))), p,
                                   *("%08x" % rng.getrandbits(32) for _ in range(20))]))
    out = {r["doc_id"]: r for r in chunkdedup.dedup(frame(spark, texts)).collect()}
    found = [out[2 * k]["__pm_removed"] + out[2 * k + 1]["__pm_removed"] for k in range(len(passages))]
    assert sum(f > 0 for f in found) == len(passages), f"{sum(f == 0 for f in found)} not found"
    assert np.mean([f / len(p.encode()) for f, p in zip(found, passages)]) > 0.75


def test_chunks_are_whole():
    rng = random.Random(6)
    data = prose(rng, 3000).encode()
    ends = chunkdedup.chunk_ends(data)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(data) and sizes.max() <= chunkdedup.MOST and sizes[:-1].min() >= chunkdedup.LEAST


# ---------------------------------------------------------------- neighbours

def brute_knn(rows, k):
    ok = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, v in ok:
        if q % 5 == 0:
            c = [(-vptree.cosines(np.array([w]), np.array(v))[0], i) for i, w in ok if i != q]
            out[q] = [i for _, i in sorted(c)[:k]]
    return out


def test_vptree_exact_and_edges(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(400)]
    rows += [(400 + i, rows[5][1]) for i in range(60)]        # a common vector: ties by id
    rows += [(900, None), (905, [0.0] * 6), (910, [float("nan")] * 6), (915, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (None, [1.0] * 6), rows[0]]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, rank string")
    got = {}
    for r in vptree.search(df, df.where("vec_id % 5 = 0"), shard_rows=90).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == brute_knn(rows, 5)
    assert vptree.search(df.limit(0), df.limit(0)).count() == 0
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0])], "vec_id long, embedding array<double>")
    assert vptree.search(few, few.where("vec_id = 0")).count() == 1


def test_vptree_relaxed_recall(spark):
    e = spark.read.parquet(f"{SF_MID}/embeddings.parquet")
    q = e.where("vec_id % 50 = 0")
    truth = vptree.search(e, q, factor=1.0)
    assert vptree.recall(vptree.search(e, q, factor=0.9), truth) >= 0.9


# ---------------------------------------------------------------- WARC

def test_warc_round_trip(spark):
    sep = "\r\n\r\nWARC/1.1\r\n"
    pages = [(1, "u", "a" * 2000), (2, "u", "a" * 2000), (3, None, None), (4, "x", "WARC/1.1\r\nabc" + sep + "z" * 1200),
             (None, "n", "q\r\n\r\n"), (5, "x", "é" * 70000), (5, "x", "é" * 70000), (6, "", sep), (7, "", "\n"),
             (8, "", "b" * 999), (9, "", "b" * 999)]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, sha1 string")
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                  for r in warc.archive(df, chunk_bytes=1000).collect())
    want = Counter()
    for i, _, h in pages:
        b = (h or "").encode()
        top = max((j for j, _, o in pages if o == h and j is not None), default=None)
        again = len(b) >= 1000 and i != top
        want[(i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", top if again else None)] += 1
    assert got == want
    assert warc.archive(df.limit(0)).count() == 0


def test_warc_cuts():
    assert warc.cuts(b"x" * 25, 10) == [10, 20, 25] and warc.cuts(b"", 10) == [0]
    data = b"ab\r\n\r\nWARC/1.1\r\nc"
    parts = [data[a:b] for a, b in zip([0, *warc.cuts(data, 100)], warc.cuts(data, 100))]
    assert b"".join(parts) == data and not any(warc.VERSION in p for p in parts)


# ---------------------------------------------------------------- near duplicates

def brute_groups(docs):
    sets = [set(minhash.shingles(t).tolist()) for _, t in docs]
    up = {i: i for i, _ in docs if i is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    seen = {}
    for (i, _), s in zip(docs, sets):
        if i is None or not s:
            continue
        for j, o in seen.items():
            if any(100 * len(s & x) >= 75 * len(s | x) for x in o):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
        seen.setdefault(i, []).append(s)
    return Counter((i, len(s), root(i) if i is not None and s else i) for (i, _), s in zip(docs, sets))


def test_near_duplicates_and_edges(spark):
    rng = random.Random(8)
    base = [prose(rng, 150).split() for _ in range(3)]
    texts = [None, "", " \t\n", "two words", "TWO words", "a b c d e", "é É"]
    for n in range(60):                                       # a chain: neighbours alike, ends not
        w = list(base[n % 3])
        w[(n // 3) * 7 % 150:(n // 3) * 7 % 150 + 6] = prose(rng, 6).split()
        texts.append(" ".join(w))
    texts += [texts[10], texts[10], prose(rng, 100_000)]
    ids = list(range(100, 100 + len(texts)))
    ids[-2], ids[5] = ids[10], None                           # a repeated row, a null id
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in minhash.groups(frame(spark, texts, ids)).collect())
    assert got == brute_groups(list(zip(ids, texts)))
    assert minhash.groups(empty(spark)).count() == 0


def test_links_of_every_text_of_an_id(spark):
    rng = random.Random(16)
    own = [prose(rng, 40) for _ in range(4)]
    texts = [(1, t) for t in own] + [(10 + k, own[k % 4]) for k in range(12)]
    pairs = spark.createDataFrame([(1, 10 + k) for k in range(12)], "a long, b long")
    got = minhash.verified(pairs, spark.createDataFrame(texts, "node long, text string")).distinct().collect()
    assert {(r.a, r.b) for r in got} == {(1, 10 + k) for k in range(12)}


def test_superminhash_estimates():
    rng = np.random.default_rng(9)
    err = []
    for _ in range(30):
        a = rng.integers(0, 2**63, 300).astype(np.uint64)
        k = int(rng.integers(50, 250))
        b = np.concatenate((a[:k], rng.integers(0, 2**63, 300 - k).astype(np.uint64)))
        s = minhash.superminhash(np.concatenate((a, b)), np.repeat([0, 1], 300), 2)
        err.append((s[0] == s[1]).mean() - k / (600 - k))
    assert abs(np.mean(err)) < 0.02 and np.std(err) < 0.04


def test_components(spark):
    from penmark.llm.components import components
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 200), (100, 300), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 200: 100, 300: 100}


# ---------------------------------------------------------------- decontamination

def test_decontamination(spark):
    rng = random.Random(10)

    def rare(n):
        return " ".join("".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(n))
    items = [(i, rare(20) + ". " + rare(14) + ".") for i in range(12)] + [(90, None), (91, ""), (None, "x y z"), (0, None)]
    swapped = items[3][1].split()
    for k in range(0, len(swapped), 6):
        swapped[k] = "changed"
    texts = [prose(rng, 80) + " " + items[0][1] + " " + prose(rng, 50), rare(300), None, "", "...",
             rare(40) + " " + " ".join(swapped) + " " + rare(60), items[5][1], items[5][1], prose(rng, 30_000)]
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int")
    got = Counter((r.doc_id, r.item_id) for r in decontam.find(frame(spark, texts), bench).collect())
    assert got == Counter([(0, 0), (5, 3), (6, 5), (7, 5)])
    assert decontam.find(frame(spark, texts), bench.limit(0)).count() == 0
    assert decontam.find(empty(spark), bench).count() == 0


def test_latent_cosine_admits_what_overlap_does_not(spark, monkeypatch):
    """An item spread over more words than a passage has is found by its cosine alone."""
    rng = random.Random(17)

    def rare(n):
        return " ".join("".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(n))
    items = [(i, rare(20) + ". " + rare(14) + ".") for i in range(12)]
    spread = [" ".join(f"{w} {rare(gap)}" for w in t.replace(".", "").split()) for (_, t), gap in zip(items, (2, 3, 3, 3))]
    texts = [*spread, rare(400), prose(rng, 500), None]
    bench = spark.createDataFrame(items, "item_id long, text string")

    def found():
        return {(r.doc_id, r.item_id) for r in decontam.find(frame(spark, texts), bench).collect()}
    assert found() == {(i, i) for i in range(4)}
    monkeypatch.setattr(decontam, "singular_vectors", lambda tok, frequency: np.zeros((len(frequency), 1)))
    assert found() == {(0, 0)}


def test_latent_search_leaves_no_passage_out(spark):
    """Every pair with the latent cosine that the subsequence accepts is found, however thinly the
    item is spread, at a cut of a long text too: equal to trying all pairs."""
    rng = random.Random(29)

    def rare(n):
        return ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(n)]
    items = [(i, " ".join(rare(20 + i % 3)) + ". " + " ".join(rare(14)) + ".") for i in range(40)]
    own = [t.replace(".", "").split() for _, t in items]

    def spread(words, gap):
        return [x for w in words for x in [w, *rare(gap)]]
    long = rare(4800 - 100) + spread(own[4], 5) + rare(4600) + spread(own[5], 5) + rare(300)
    # the whole items among the texts give the latent space a direction for each
    texts = [spread(own[i], 4 + i % 2) for i in range(12)] + [long, rare(500), own[7], *2 * own]
    texts = [" ".join(t) for t in texts]
    made = decontam.Items(items)
    tok = decontam.tokens(frame(spark, texts), made.vocab).cache()
    frequency, idf = decontam.passage_frequency(tok, len(made.vocab))
    vectors = decontam.singular_vectors(tok, frequency)
    got = {(r.doc_id, r.item_id): r.lcs for r in decontam.search(tok, made, idf, vectors, "bigint").collect()}

    def unit(x):
        return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-9)
    squared, table = made.weights(idf) ** 2, vectors * idf[:, None]
    target, want, thick = unit(made.weights(idf) @ vectors), {}, set()
    for d, t in enumerate(texts):
        ids = np.array([made.vocab.get(w, -1) for w in t.split()])
        for at in range(0, len(ids), decontam.BLOCK):
            held = ids[at:at + decontam.WORDS]
            held = held[held >= 0]
            cos, share = target @ unit(table[held].sum(0)), squared[:, np.unique(held)].sum(1)
            for p in np.flatnonzero((cos >= decontam.LATENT) | (share >= decontam.OVERLAP)):
                i = made.passages[p][0]
                region = ids[max(0, at - len(made.words[i])):at + decontam.WORDS + len(made.words[i])]
                w, region = idf[made.words[i]], region[region >= 0]
                used = decontam.common_subsequence(made.words[i], region, w)
                lcs, answer = w[used].sum() / w.sum(), w[made.answers[i]:][used[made.answers[i]:]].sum() / w[made.answers[i]:].sum()
                if lcs >= decontam.NEAR or lcs >= decontam.PARAPHRASE and answer >= decontam.ANSWER:
                    key = d, made.ids[i]
                    want[key] = max(want.get(key, 0), lcs)
                    thick |= {key} if share[p] >= 0.2 else set()
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert {(12, 4), (12, 5)} <= want.keys() - thick


def test_words_cut_as_bytes_are_the_same_words():
    vocab = {w: n for n, w in enumerate(["µ", "ß", "é", "ÿ", "x_1", "½", "ω", "k", "i̇x", "ª²k"])}
    numbers = decontam.numbered_words(vocab)
    for text in ["µ ß É Ÿ x_1 ½", "K Ω é", "İx", "a\x85k\xa0k\x1ck", "", "ÿ×é÷ß", "ª²k k", "K\tk\x0bk"]:
        assert numbers(text).tolist() == [vocab.get(w, -1) for w in decontam.WORD.findall(text.lower())]


def test_decontamination_finds_every_verbatim_item(spark):
    import re
    def norm(t):
        return " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF_MID}/benchmark.parquet").collect()
    want = {(d.doc_id, i.item_id) for d in docs for i in items if norm(i.text) in norm(d.text)}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op9_latent_decontamination"](spark, SF_MID).collect()}
    assert want and want <= got and len(got) <= 1.2 * len(want)


def test_decontamination_recall_of_planted_items(spark):
    """Every planted item that the overlap and the subsequence rule accept is
    found, verbatim or with half of its question changed."""
    rng = random.Random(13)
    docs = spark.read.parquet(f"{SF_LARGE}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{SF_LARGE}/benchmark.parquet")
    base, texts = docs.collect(), sorted((r.item_id, r.text) for r in bench.collect())
    hosts = rng.sample([r for r in base if len(r.text or "") > 2000], 3 * len(texts))
    words, planted = [w for r in hosts for w in r.text.split()], {}
    for k, (item, text) in enumerate(texts * 3):
        part = text.split()
        # the last third stays: it holds the answer
        for j in range(2 * len(part) // 3):
            if k >= len(texts) and rng.random() < 0.5:
                part[j] = rng.choice(words)
        host = hosts[k].text.split()
        at = rng.randrange(len(host))
        planted[hosts[k].doc_id] = (item, " ".join(host[:at] + part + host[at:]))
    changed = spark.createDataFrame([(d, t) for d, (_, t) in planted.items()], docs.schema)
    docs = docs.where(~F.col("doc_id").isin(list(planted))).unionByName(changed)
    got = {(r.doc_id, r.item_id) for r in decontam.find(docs, bench).collect()}

    items = decontam.Items(texts)
    find = decontam.WORD.findall
    seen, n = Counter(), 0
    for text in [r.text for r in base if r.doc_id not in planted] + [t for _, t in planted.values()]:
        ids = [items.vocab.get(w, -1) for w in find((text or "").lower())]
        for lo in range(0, len(ids), decontam.WORDS):
            seen.update(set(ids[lo:lo + decontam.WORDS]))
            n += 1
    idf = np.log((1 + n) / (1 + np.array([seen[w] for w in range(len(items.vocab))]))) + 0.02
    squared = items.weights(idf) ** 2
    want = set()
    for d, (item, text) in planted.items():
        ids = np.array([items.vocab.get(w, -1) for w in find(text.lower())])
        i = items.ids.index(item)
        mine = [squared[r] for r, (o, _) in enumerate(items.passages) if o == i]
        for at in range(0, len(ids), decontam.BLOCK):
            held = np.unique(ids[at:at + decontam.WORDS])
            held = held[held >= 0]
            # a hair over the limits: sums differ in their last digits
            if max(q[held].sum() for q in mine) > decontam.OVERLAP + 1e-4 and decontam.confirm(
                    ids, at, items.words[i], items.answers[i], idf * (1 + 1e-9))[2]:
                want.add((d, item))
    verbatim = {(hosts[k].doc_id, item) for k, (item, _) in enumerate(texts)}
    assert verbatim <= want and len(want) > 1.5 * len(verbatim)
    assert want <= got, f"{len(want - got)} of {len(want)} missed"


def test_common_subsequence():
    a, b = np.array([1, 2, 3, 4, 5]), np.array([9, 1, 3, 2, 4, 9])
    used = decontam.common_subsequence(a, b, np.array([1.0, 5.0, 1.0, 1.0, 1.0]))
    assert used.tolist() == [True, True, False, True, False]


# ---------------------------------------------------------------- repeated substrings

def brute_repeats(texts, n):
    data = [(t or "").encode() for t in texts]
    c = Counter(d[i:i + n] for d in data for i in range(len(d) - n + 1))
    out = []
    for d in data:
        hit = np.zeros(len(d), int)
        for i in range(len(d) - n + 1):
            if c[d[i:i + n]] > 1:
                hit[i:i + n] = 1
        kept = bytes(np.frombuffer(d, np.uint8)[hit == 0])
        out.append((len(d), int(hit.sum()), int((np.diff(hit, prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("bin_bytes", [bwtdedup.BIN_BYTES, 3000])
def test_repeated_substrings(spark, bin_bytes):
    rng = random.Random(11)
    p = [prose(rng, 250) for _ in range(3)]
    texts = [None, "", "é" * 900, p[2][:399], p[2][:400], "ab" * 900]
    for i in range(30):
        w = list(p[1])
        for _ in range(2):
            w[rng.randrange(len(w))] = "#"
        texts += [prose(rng, 30) + p[0] + prose(rng, 20), "".join(w), prose(rng, 9) + p[2][:430] + p[2][80:600]]
    texts.append(texts[6])
    ids = list(range(len(texts)))
    ids[-1], ids[3] = ids[6], None
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                  for r in bwtdedup.dedup(frame(spark, texts, ids), bin_bytes=bin_bytes).collect())
    assert got == Counter((i, *r) for i, r in zip(ids, brute_repeats(texts, 400)))
    assert bwtdedup.dedup(empty(spark)).count() == 0


def test_merge_of_shards_equals_brute_force(monkeypatch):
    monkeypatch.setattr(bwtdedup, "SHARD_BYTES", 700)
    rng = random.Random(12)
    p = prose(rng, 120)
    parts = [(prose(rng, 20) + p[a:a + 500]).encode() for a in (0, 10, 30, 90)] + [prose(rng, 100).encode(), b"x" * 600]
    got = bwtdedup.repeats(parts, [1] * 5 + [3])
    c = Counter(d[i:i + 400] for d, m in zip(parts, [1] * 5 + [3]) for i in range(len(d) - 399) for _ in range(m))
    for d, r in zip(parts, got):
        hit = {x for i in range(len(d) - 399) if c[d[i:i + 400]] > 1 for x in range(i, i + 400)}
        assert {x for a, b in r for x in range(a, b)} == hit


def shared_prefixes(shard_parts, length=400):
    """(position, whole symbols' bytes shared with any other suffix) of every shard, by its transforms and by brute force."""
    shards, texts = [], []
    for parts in shard_parts:
        lens = np.array([len(p) + 1 for p in parts])
        first = np.concatenate(([0], np.cumsum(lens)))
        part = np.repeat(np.arange(len(parts)), lens)
        here = np.arange(first[-1])
        text = np.frombuffer(b"".join(p + b"\0" for p in parts), np.uint8)
        shards.append(bwtdedup.Shard(text, here - first[part], first[part + 1] - 1 - here, length))
        texts.append([p[i:] for p in parts for i in range(len(p) + 1)])
    seen = Counter(t[:n] for ts in texts for t in ts for n in range(16, length + 1, 16) if len(t) >= n)
    brute = [[max((n for n in range(16, length + 1, 16) if len(t) >= n and seen[t[:n]] > 1), default=0) for t in ts] for ts in texts]
    return shards, brute


def by_position(shards, length=400):
    out = []
    for s, shared in zip(shards, bwtdedup.interleave(shards, length)):
        out.append(np.empty(len(shared), int))
        out[-1][s.suffix] = shared
    return [x.tolist() for x in out]


def test_interleave_gives_common_prefixes():
    rng = random.Random(21)
    p = prose(rng, 130)
    cuts = [(0, 500), (40, 520), (90, 480), (0, 470), (200, 620)]
    parts = [(prose(rng, 6) + p[a:b]).encode() for a, b in cuts]
    for groups in ([parts], [parts[:2], parts[2:4], parts[4:]], [[x] for x in parts], [[b"short"], parts, [b""], [b"z" * 460]]):
        shards, brute = shared_prefixes(groups)
        assert by_position(shards) == brute


def test_merge_reads_the_shards_order():
    """The merge knows the transforms only: with a shard's order disturbed it goes wrong."""
    rng = random.Random(22)
    p = prose(rng, 130)
    groups = [[(prose(rng, 6) + p[a:a + 470]).encode()] for a in (0, 30, 60)]
    shards, brute = shared_prefixes(groups)
    assert by_position(shards) == brute
    for s in shards:
        mixed = np.random.default_rng(1).permutation(len(s.suffix))
        s.suffix, s.before = s.suffix[mixed], s.before[mixed]
        s.back[bwtdedup._deal(s.before)] = np.arange(len(s.before))
    assert by_position(shards) != brute


def test_repeats_on_documents_at_sf001(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in bwtdedup.dedup(docs).collect()}
    rows = docs.collect()
    assert got == {r.doc_id: x for r, x in zip(rows, brute_repeats([r.text for r in rows], 400))}


def test_hot_keys_join_like_the_others(spark):
    rows = spark.range(30_000).select((F.col("id") % 3 * F.col("id")).alias("g"), "id")
    from penmark.session import cut_lineage
    keyed = cut_lineage(rows.groupBy("g").agg(F.count(F.lit(1)).alias("c"), F.max("id").alias("top")), "keyed")
    got = bwtdedup.by_key(rows, keyed, ["g"], "c")
    assert got.columns == ["g", "id", "top"]
    assert got.exceptAll(rows.join(keyed.drop("c"), "g")).count() == 0 and got.count() == 30_000


# ---------------------------------------------------------------- pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    extra = spark.createDataFrame([(None, None, None, None, None), (10**6, "", "en", "s", 0), (10**6, "", "en", "s", 0)], docs.schema)
    docs = docs.unionByName(extra)
    kept = []
    for name, stage in P.STAGES[:-1]:
        from penmark.session import cut_lineage
        out = cut_lineage(stage(spark, docs, SF_SMALL), name)
        assert out.columns == docs.columns
        kept.append(out.count())
        docs = out
    assert kept == sorted(kept, reverse=True)
    ids = [r.doc_id for r in docs.collect()]
    assert len([i for i in ids if i is not None]) == len({i for i in ids if i is not None}) and None in ids and 10**6 in ids
    packed = P.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    check_packing(packed, [(r.doc_id, r.text) for r in docs.collect()], 2048)
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_duplicates", "repeated_substrings", "decontamination", "packing"]


def test_near_duplicate_stage_judges_texts_not_ids(spark):
    import corpus_pipeline as P
    rng = random.Random(15)
    a, b, c, d = (prose(rng, 60) for _ in range(4))
    rows = [(1, a), (1, b), (2, b), (3, c), (None, c), (None, d), (None, d), (None, None), (None, None), (4, ""), (4, ""), (4, None), (5, a)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, lang string")
    got = Counter((r.doc_id, r.text) for r in P.keep_one_of_each_group(spark, docs, SF_SMALL).collect())
    assert got == Counter([(1, a), (1, b), (3, c), (None, d), (None, None), (None, None), (4, ""), (4, None)])


def brute_toxic(text, model):
    import re
    none = 1.0
    for sentence in re.split(r"[.!?\n]+", (text or "").lower()):
        words = re.findall(r"[^\W\d_]+", sentence)
        if words:
            z = sum(float(model.weights[i]) for w in words for i in toxicity.buckets(w)) + model.bias
            none *= 1 - 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    return 1 - none


def brute_leaks(rows, bench):
    """Documents of which a sliding passage is accepted for some item."""
    items = decontam.Items(bench)
    ids = [np.array([items.vocab.get(w, -1) for w in decontam.WORD.findall((t or "").lower())], np.int32) for _, t in rows]
    seen, n = Counter(), 0
    for x in ids:
        for lo in range(0, len(x), decontam.WORDS):
            seen.update(set(x[lo:lo + decontam.WORDS].tolist()))
            n += 1
    idf = np.log((1 + n) / (1 + np.array([seen[w] for w in range(len(items.vocab))]))) + 0.02
    squared, out = items.weights(idf) ** 2, set()
    for (d, _), x in zip(rows, ids):
        for at in range(0, len(x), decontam.BLOCK):
            held = np.unique(x[at:at + decontam.WORDS])
            for p in np.flatnonzero(squared[:, held[held >= 0]].sum(1) >= decontam.OVERLAP):
                i = items.passages[p][0]
                if d not in out and decontam.confirm(x, at, items.words[i], items.answers[i], idf)[2]:
                    out.add(d)
    return out


def test_pipeline_stages_keep_what_brute_force_keeps(spark):
    import corpus_pipeline as P
    from penmark.llm.queries import toxicity_model
    from penmark.session import cut_lineage
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = toxicity_model(spark, SF_SMALL)
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    dropped = {}
    for name, stage in P.STAGES[:-1]:
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        out = cut_lineage(stage(spark, docs, SF_SMALL), name)
        if name == "toxicity":
            want = {i for i, t in rows if brute_toxic(t, model) < toxicity.THRESHOLD}
        elif name == "near_duplicates":
            want = {i for i, _, top in brute_groups(rows) if i == top}
        elif name == "repeated_substrings":
            want = {i for i, _ in rows}
        else:
            want = {i for i, _ in rows} - brute_leaks(rows, bench)
        got = [r.doc_id for r in out.collect()]
        assert sorted(got) == sorted(want), name
        dropped[name] = len(rows) - len(got)
        docs = out
    print(dropped)
    assert dropped["near_duplicates"] > 0 and dropped["decontamination"] > 0
