"""Hashed counts of texts for the epoch trainer."""

import hashlib
import re
import time
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from penmark.operators.epochs import hashed


def test_counts_of_odd_texts(spark):
    texts = ["a b a, A_b 7", "", None, "...", "É é ß x2 x2 x2", "w " * 50, "one\ntwo\tone"]
    df = spark.createDataFrame([(i, t, "q" if i % 2 else "p") for i, t in enumerate(texts)], "id int, text string, label string")
    got = {r["row_key"]: r for r in hashed(df, "id", "text", "label", ["p", "q"], 16).collect()}
    for i, t in enumerate(texts):
        words = [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
        n = Counter(int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 16 for w in words)
        norm = np.sqrt(sum(x * x for x in n.values()))
        assert got[str(i)]["bucket"] == sorted(n) and got[str(i)]["weight"] == [n[b] / norm for b in sorted(n)]
        assert got[str(i)]["label_idx"] == i % 2


def test_time_grows_with_a_texts_length_not_its_square(spark):
    def seconds(words: int) -> float:
        text = " ".join(f"w{i}" for i in range(words))
        df = spark.createDataFrame([(1, text)], "id int, text string")
        begun = time.time()
        n = hashed(df, "id", "text", None, [""], 1 << 20).select(F.size("bucket")).first()[0]
        assert n > 0.85 * words
        return time.time() - begun

    seconds(1_000)
    assert seconds(200_000) < 15    # a search for every bucket among all took minutes
