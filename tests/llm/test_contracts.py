"""Contracts of the scoring queries, clashing columns, and what a sample moves."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from penmark.llm import bytecnn, chunkdedup, common, minhash, ordinal, toxicity, vptree
from penmark.llm.queries import QUERIES, RATING, toxicity_model
from tests.conftest import SF_SMALL


def docs_of(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def test_op1_query(spark):
    got = {r["doc_id"]: r for r in QUERIES["op1_toxicity_mil"](spark, SF_SMALL).collect()}
    model = toxicity_model(spark, SF_SMALL)
    rows = docs_of(spark).collect()
    assert len(got) == len(rows)
    weight = toxicity.WordWeights(model.weights)
    for r in rows:
        g = got[r["doc_id"]]
        assert g["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert g["predicted"] == int(g["score"] >= 0.7) and 0 <= g["score"] <= 1
        none = 1.0
        for s in toxicity.SENTENCE.finditer(r["text"] or ""):
            words = [w for w in toxicity.TOKEN.findall(s.group().lower()) if w[0] not in toxicity.ENDS]
            if words:
                none *= 1 - float(model.sentences(np.array([weight[w] for w in words]), np.zeros(len(words), np.int64), 1)[0])
        assert abs(g["score"] - (1 - none)) < 1e-6


def test_op2_query(spark):
    got = {r["doc_id"]: r for r in QUERIES["op2_quality_ordinal"](spark, SF_SMALL).collect()}
    d = docs_of(spark)
    train = d.where(~common.held_out("doc_id", 5, 0))
    model = ordinal.train(train, spark.read.parquet(f"{SF_SMALL}/labels.parquet"), F.expr(RATING))
    cache = ordinal.Shapes(len(model.weights))
    rows = d.collect()
    assert len(got) == len(rows)
    for r in rows:
        g = got[r["doc_id"]]
        _, ids, val = ordinal.features([r["text"]], cache)
        z = float((model.weights[ids] * val).sum())
        up = [1 / (1 + np.exp(t - z)) for t in model.thresholds]
        assert g["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert g["selected"] == (g["tail_prob"] >= 0.5) and abs(g["tail_prob"] - up[0]) < 1e-4
        want = model.grades[0] + sum(p * (b - a) for p, a, b in zip(up, model.grades, model.grades[1:]))
        assert abs(g["expected_grade"] - want) < 1e-4


def test_sample_takes_distinct_texts_and_moves_no_other(spark):
    rows = [(i, f"t{i // 3}", "e") for i in range(90)] + [(500 + i, "copy", "e") for i in range(200)] + [(None, "x", "e"), (900, None, "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, extra string")
    lab = spark.createDataFrame([(i, float(i % 2)) for i in range(1000)], "__pm_id long, __pm_y double")
    got = common.labelled_sample(df, lab, lambda n: 10, "doc_id", "text")
    assert [y for y, _ in got] == [0.0] * 10 + [1.0] * 10 and len(set(got)) == 20
    for y in (0.0, 1.0):
        want = common.bounded_sample(df.join(lab, F.col("doc_id") == F.col("__pm_id")).where(F.col("__pm_y") == y).select("text"), "text", 10)
        assert [t for v, t in got if v == y] == [r["text"] for r in want.collect()]
    with pytest.raises(ValueError):
        common.labelled_sample(df, lab.withColumn("__pm_y", F.col("__pm_id") / 7), lambda n: 1, "doc_id", "text")
    assert common.labelled_sample(df, lab.limit(0), lambda n: 1, "doc_id", "text") == []
    h = F.xxhash64(F.lit(7), F.col("text"))
    plan = (df.select(F.col("doc_id").alias("__pm_id"), h.alias("__pm_h")).join(lab.hint("merge"), "__pm_id")
            ._jdf.queryExecution().optimizedPlan().toString())
    assert plan.index("Join") < plan.index("xxhash64")            # hashed below the join


def test_callers_columns_stay(spark):
    df = spark.createDataFrame([(1, "aa bb", "mine", "mine", "mine", "mine")], "doc_id long, text string, toxicity string, quality string, selected string, language string")
    tox = toxicity.score(df, toxicity.NoisyOr(np.zeros(toxicity.N_BUCKETS, np.float32), -4.0)).first()
    assert tox["toxicity"] == "mine" and tox["toxicity_"]["score"] > 0
    q = ordinal.score(df, ordinal.Ordinal(np.zeros(16), np.array([0.0]), [0.0, 1.0])).first()
    assert (q["quality"], q["selected"]) == ("mine", "mine") and q["quality_"]["tail_prob"] == 0.5 and q["selected_"] is True
    lang = bytecnn.predict(df, None).first()
    assert lang["language"] == "mine" and lang["language_"]["lang_pred"] == "und"


@pytest.mark.parametrize("text,letter", [("² ½ 100", False), ("①", False), ("Ⅷ", False), ("_ 1 -", False), ("", False), ("1 é", True), ("ß", True), ("٣ ع", True), ("x", True)])
def test_letters_are_category_l(text, letter):
    assert bytecnn.has_letter(text) == letter


def test_huge_and_tiny_components(spark):
    rows = [(i, [float(x) * s for x in v]) for i, (v, s) in enumerate([((3, 4), 1e200), ((4, 3), 1e-200), ((3, 4), 1.0), ((-3, 4), 1e-300), ((1, 0), 1e308)])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vptree.search(df, df.where("vec_id = 0")).orderBy("rank").collect()
    assert [(r["vec_id"], round(r["score"], 12)) for r in got] == [(2, 1.0), (1, 0.96), (4, 0.6), (3, 0.28)]


def test_an_original_links_its_copies_at_once(spark):
    """Copies that resemble the original but not each other: the original is the
    centre of its buckets, and one round finds the group."""
    rng = np.random.default_rng(0)
    base = [f"w{i}" for i in range(300)]
    texts = []
    for c in range(60):
        t = list(base)
        for i in rng.choice(290, 7, replace=False):
            t[i] = f"c{c}x{i}"
        texts.append(" ".join(t))
    rows = [(1000 - i, t) for i, t in enumerate([*texts, " ".join(base)])]
    got = minhash.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in got} == {min(i for i, _ in rows)}


def test_open_buckets_are_compared_in_blocks(spark, monkeypatch):
    """Chains whose links no centre finds, in buckets of several blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 3)
    monkeypatch.setattr(minhash, "STARS", 1)
    words = [f"w{i}" for i in range(260)]
    rows = [(i, " ".join(words[i * 3:i * 3 + 60])) for i in range(60)]       # neighbours resemble each other, ends do not
    rows += [(100 + i, " ".join(words[:20] + [f"x{i}y{j}" for j in range(40)])) for i in range(30)]   # a shared passage, no links
    got = {r["doc_id"]: r["component_id"] for r in minhash.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: set(minhash.shingles(t).tolist()) for i, t in rows}
    up = {i: i for i in sets}
    for _ in range(60):
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    up[a] = up[b] = min(up[a], up[b])
        if all(up[up[i]] == up[i] for i in up):
            break
    assert got == up


def test_chunk_dedup_keeps_a_callers_text_column(spark):
    body = " ".join(f"word{i}" for i in range(80))
    df = spark.createDataFrame([(1, body, "mine"), (2, "intro " + body, "too"), (3, None, None)], "doc_id long, body string, text string")
    got = {r["doc_id"]: r for r in chunkdedup.dedup(df, text_col="body").collect()}
    assert got[1]["body"] == body and got[1]["text"] == "mine" and got[2]["text"] == "too" and got[3]["body"] is None
    assert got[2]["__pm_removed"] > 300 and len(got[2]["body"]) < 200
    plain = chunkdedup.dedup(df.drop("text"), text_col="body")
    assert "text" not in plain.columns and plain.count() == 3


def test_hot_chunks_meet_their_first_row_in_parts(spark, monkeypatch):
    common = " ".join(f"shared{i} line{i * 7}" for i in range(40))
    d = spark.createDataFrame([(i, f"{common} own{i} " * (1 + i % 2)) for i in range(80)] + [(90, None), (91, "")], "doc_id long, text string")
    want = sorted((r["doc_id"], r["__pm_removed"], r["text"] or "") for r in chunkdedup.dedup(d).collect())
    monkeypatch.setattr(chunkdedup, "HOT_LEAST", 40)
    hashes = chunkdedup.repeated_hashes(d.select(F.col("doc_id").alias("__pm_row"), "text"))
    assert all(b.any() for b in hashes) and not (hashes[1] & ~hashes[0]).any()
    assert sorted((r["doc_id"], r["__pm_removed"], r["text"] or "") for r in chunkdedup.dedup(d).collect()) == want
    assert sum(r[1] > 0 for r in want) >= 79


def test_a_full_bitmap_changes_no_result(spark, monkeypatch):
    d = docs_of(spark).select("doc_id", "text").limit(60)
    want = sorted((r["doc_id"], r["__pm_removed"], r["text"]) for r in chunkdedup.dedup(d).collect())
    monkeypatch.setattr(chunkdedup, "marked", lambda bits, h: np.ones(len(h), bool))
    assert sorted((r["doc_id"], r["__pm_removed"], r["text"]) for r in chunkdedup.dedup(d).collect()) == want
    assert any(r[1] for r in want)
