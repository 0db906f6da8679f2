"""Mined phrases against a plain count of every phrase."""

import random
import re
from collections import Counter

import numpy as np

from penmark.llm import setm

SCHEMA = "doc_id long, text string, lang string, piece string, pos string, word string, w1 int, rank int, n int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "p", "q", "w", 1, 2, 3) for i, (t, g) in enumerate(rows)], SCHEMA)


def brute(rows, longest=3, least=10, percent=50, top=2000):
    f, n = {}, Counter()
    for text, lang in rows:
        g = f.setdefault("und" if lang is None else lang, Counter())
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n["und" if lang is None else lang] += len(ws)
            for k in range(1, longest + 1):
                g.update(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, g in f.items():
        found = []
        cand = {p: a for p, a in g.items() if len(p) > 1 and a >= least}
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= percent * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in cand.items()):
                continue
            s, _, l, r = min((1000000 * a * a // (g[p[:c]] * g[p[c:]]), c, g[p[:c]], g[p[c:]]) for c in range(1, len(p)))
            found.append((-s, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])]
    return sorted(out)


def mined(spark, rows, **kw):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
                  for r in setm.mine(frame(spark, rows), **kw).collect())


def prose(rng, n):
    return "".join(rng.choice(["Ab", "cD", "é", "É", "x", "y", "zu-z", " "]) + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\x0b", ""])
                   for _ in range(n))


def test_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(prose(rng, rng.randint(0, 90)), rng.choice(["en", "fr", None, "und"])) for _ in range(120)]
    want = brute(rows)
    assert len(want) > 50 and mined(spark, rows) == want
    assert mined(spark, rows, longest=5, min_count=4, inside_percent=80, top=25) == brute(rows, 5, 4, 80, 25)
    assert mined(spark, rows, longest=2) == brute(rows, 2)


def test_large_vocabulary_path_is_equal(spark, monkeypatch):
    """Hashes instead of numbers, and a bitmap so small that it keeps most phrases."""
    rng = random.Random(3)
    rows = [(prose(rng, 60), "en") for _ in range(60)]
    monkeypatch.setattr(setm, "MAX_WORDS", 0)
    assert mined(spark, rows) == brute(rows)


def test_false_hits_of_the_bitmap_change_nothing(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(prose(rng, 80), "en") for _ in range(40)]
    monkeypatch.setattr(setm.Bitmap, "has", lambda self, cols: np.ones(len(cols[0]), bool))
    words = mined(spark, rows, longest=4)
    assert words == brute(rows, 4)


def test_words_in_windows(monkeypatch):
    """Windows cut between words give the words, places and hashes of one pass."""
    rng = random.Random(5)
    text = (prose(rng, 400) + " " + "w" * 300 + prose(rng, 50)).encode()
    whole = setm.Words(0).of_texts([text, b"", b"x y"], np.zeros(3, np.uint64))
    monkeypatch.setattr(setm, "STEP_BYTES", 40)
    for a, b in zip(whole, setm.Words(0).of_texts([text, b"", b"x y"], np.zeros(3, np.uint64))):
        assert (a == b).all()
    low = setm.LOWER[whole[0]].tobytes()
    pieces = [re.findall(rb"[^\x20\x09]+", p) for p in re.split(rb"[.,;:!?\x0A-\x0D]", low)]
    want = [w for p in pieces for w in p]
    assert [low[s:e] for s, e in zip(whole[1], whole[2])] == want
    together = [(a, b) for p in pieces for a, b in zip(p, p[1:])]
    near = np.flatnonzero(np.diff(whole[4]) == 1)
    assert [(want[i], want[i + 1]) for i in near] == together


def test_a_shared_hash_changes_the_seed(spark, monkeypatch):
    class Poor(setm.Words):
        def __init__(self, seed):
            super().__init__(seed)
            if seed == 0:
                self.byte = np.ones(256, np.uint64)      # anagrams and more share a hash
    monkeypatch.setattr(setm, "Words", Poor)
    rows = [("ab ba ab ba cd", "en")] * 12
    docs = frame(spark, rows).select("text", "lang")
    seed, counts = setm.word_counts(docs)
    assert seed == 1 and sorted((r["word"], r["f"]) for r in counts.collect()) == [("ab", 24), ("ba", 24), ("cd", 12)]


def test_edges(spark):
    rows = [(None, "en"), ("", "en"), (" \t ", "en"), ("...", None), ("a", "en"), ("a b " * 30000, "de"), ("one two" * 1, "fr")]
    rows += [("Hot hot hot", "fr")] * 40 + [("x\x01y z", None)] * 10 + [("q  r\ts", "en")] * 9
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, []) == []
    assert mined(spark, [(None, None)]) == []


def test_counts_beyond_64_bits_are_exact(spark):
    big = 900_000_000_000_007
    often = spark.createDataFrame([("en", "a", big + 2, 1), ("en", "b", big + 5, 2)], "lang string, word string, f long, w long")
    found = spark.createDataFrame([(1, 2, big)], "w1 long, w2 long, f long")
    r = setm.scored(2, often, {2: found}).first()
    assert r["score"] == 1000000 * big * big // ((big + 2) * (big + 5))


def test_relations_move_no_occurrence(spark):
    """Neither building nor extending a relation has an exchange; only counts have."""
    docs = frame(spark, [("a b c. a b", "en")] * 20).select("text", "lang")
    numbers = setm.Numbers(np.sort(np.arange(5, dtype=np.uint64)), None)
    r1 = docs.mapInArrow(setm.first_relation(0, numbers), "step array<int>, w array<int>, begins array<boolean>")
    plan = r1.mapInArrow(setm.phrases(1), "w1 long, w2 long")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
