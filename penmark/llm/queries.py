"""Registered queries of the training-data operators, each over its whole
table with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from penmark.llm import bwtdedup, bytecnn, chunkdedup, decontam, hardneg, minhash, ordinal, packing, setm, toxicity, urlrules, vptree, warc
from penmark.llm.common import held_out, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.NoisyOr:
    """Learned from documents whose crc32(doc_id) mod 3 is not 1."""
    docs = read(spark, sf_dir, "documents")
    return toxicity.train(docs.where(~held_out("doc_id", 3, 1)), read(spark, sf_dir, "labels"))


@query("op1_toxicity_mil")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    s = toxicity.score(docs, toxicity_model(spark, sf_dir))
    return s.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), F.col("toxicity.score").alias("score"),
                    (F.col("toxicity.score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
                    F.size("toxicity.spans").alias("n_toxic_sentences"))


#: Graded rating from the label table: 0 poor, 1 good but toxic, 2 good and clean.
RATING = "quality * (2 - coalesce(toxic, 0))"


@query("op2_quality_ordinal")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = ordinal.train(docs.where(~held_out("doc_id", 5, 0)), read(spark, sf_dir, "labels"), F.expr(RATING))
    s = ordinal.score(docs, model)
    return s.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "quality.expected_grade", "quality.tail_prob", "selected")


@query("op3_language_id_cnn")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = bytecnn.train(docs.where(~held_out("doc_id", 5, 0)))
    s = bytecnn.predict(docs.select("doc_id", "text"), model)
    return s.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "language.lang_pred", "language.score")


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@query("op4_bestfit_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(read(spark, sf_dir, "documents"), *tokenizer_paths()))


@query("op5_chunk_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = chunkdedup.dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", "text", F.col("__pm_bytes").alias("n_bytes"), F.col("__pm_removed").alias("n_removed"),
                    F.size("__pm_spans").cast("long").alias("n_spans"))


@query("op6_vptree_knn", """
WITH e AS (SELECT vec_id, [x::DOUBLE for x in embedding] v FROM embeddings
           WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
             AND len([x for x in embedding if x <> 0]) > 0),
p AS (SELECT q.vec_id query_id, c.vec_id,
             list_dot_product(q.v, c.v) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(c.v, c.v))) score
      FROM e q JOIN e c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 5""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "embeddings")
    return vptree.search(e, e.where("vec_id % 50 = 0"))


@query("op7_warc_chunks", """
WITH p AS (SELECT page_id, coalesce(html, '') h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT payload_bytes, sha1(h) payload_digest, max(page_id) OVER (PARTITION BY h) top FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
FROM d""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(read(spark, sf_dir, "pages"))


@query("op8_superminhash_dedup", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') sh
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - 4) + 1)) i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) n FROM s GROUP BY 1),
l AS (SELECT a.doc_id a, b.doc_id b, count(*) c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
k AS (SELECT a, b FROM l JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id top FROM n UNION SELECT k.a, r.top FROM r JOIN k ON k.b = r.doc_id)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(t.top, w.doc_id) AS component_id,
       coalesce(t.top, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(top) top FROM r GROUP BY 1) t USING (doc_id)""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups(read(spark, sf_dir, "documents"))


@query("op9_latent_decontamination")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "word", "cosine", "lcs", "answer")


@query("op10_bwt_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwtdedup.dedup(read(spark, sf_dir, "documents")).drop("spans")


@query("op11_rns_hard_negatives", """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END label,
                  [floor(256 * x::DOUBLE)::BIGINT for x in embedding] c
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id anchor_id, b.vec_id vec_id, a.label = b.label same,
             list_sum([x[1] * x[2] for x in list_zip(a.c, b.c)])::BIGINT score
      FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id positive_id, score positive_score
      FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) r FROM s WHERE same) WHERE r <= 5),
n AS (SELECT p.*, s.vec_id negative_id, s.score negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) r
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
       AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, r::INT AS rank, negative_id, positive_score, negative_score FROM n WHERE r <= 3""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(e.select("vec_id", label.alias("label"), "embedding"), F.col("vec_id") % 50 == 0)


@query("op12_setm_phrases", r"""
WITH p AS (SELECT coalesce(lang, 'und') lang,
                  unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[.,;:!?\x0A-\x0D]')) piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') ws FROM p),
t AS (SELECT lang, sum(len(ws))::BIGINT n FROM w GROUP BY 1),
g AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') ph, count(*) f
      FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) i FROM w CROSS JOIN (VALUES (1), (2), (3)) ks(k) WHERE len(ws) >= k)
      GROUP BY 1, 2, 3),
c AS (SELECT lang, k, ph, f a, string_split(ph, ' ') ws FROM g WHERE k > 1 AND f >= 10),
u AS (SELECT c.*, cut, x.f l, y.f r, ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT score
      FROM (SELECT *, unnest(range(1, k)) cut FROM c) c
      JOIN g x ON x.lang = c.lang AND x.k = cut AND x.ph = array_to_string(c.ws[1:cut], ' ')
      JOIN g y ON y.lang = c.lang AND y.k = c.k - cut AND y.ph = array_to_string(c.ws[cut + 1:c.k], ' ')),
m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, ph ORDER BY score, cut) o FROM u) WHERE o = 1),
h AS (SELECT lang, part, max(a) held FROM (
        SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) part FROM c WHERE k = 3) GROUP BY 1, 2),
d AS (SELECT m.* FROM m LEFT JOIN h ON h.lang = m.lang AND h.part = m.ph AND m.k = 2 WHERE held IS NULL OR 100 * held < 50 * a)
SELECT lang, rank, ph AS phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, ph) AS rank FROM d) JOIN t USING (lang)
WHERE rank <= 2000""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setm.mine(read(spark, sf_dir, "documents").select("text", "lang"))


#: The given URL rules (host, path, verdict).
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


@query("op13_url_rules")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.judge(read(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).withColumn("mined", F.array_join("mined", " "))
