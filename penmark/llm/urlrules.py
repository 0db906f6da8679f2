"""URL filter: given rules first, mined association rules for the rest.

A given rule is (host, path, verdict); it fits a URL whose host is the rule's or
one below it and whose path starts with the rule's.  The longest one that fits
decides; of equally long ones the one with the longer host, then the one that
blocks.

URLs that no given rule fits are judged by rules learned from labelled URLs:
Spark's FP-growth mines combinations of URL tokens together with the label, and
association rules "tokens -> label" are pruned by support, by confidence, and
where a rule with one token less is as sure.  Learned rules are found by an
inverted index: each rule is posted under its rarest token, a URL's tokens are
joined with the postings and the rule's other tokens looked for among the URL's.
Of the rules that fit the surest decides, then the one with more support, then
the one that blocks, then the smaller tokens; where none fits, ``default``.

Defined results: a null URL, or one without ``://``, has empty host and path, no
tokens, and takes the default (an empty rule path fits any path, an empty host
only itself).  Very long URLs are read whole; equal URLs get equal verdicts, each
row its own.  An empty table gives none.  Without labelled rows nothing is learned.
Extra columns of the caller's table are kept out of the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from penmark.operators.joins import small_table
from penmark.session import cut_lineage

#: A combination must hold for this share of the labelled rows and this many of them.
MIN_SUPPORT, MIN_ROWS = 0.01, 10
MIN_CONFIDENCE = 0.8
RULE = "rule string, r_host string, r_path string, verdict string"


# --------------------------------------------------------------- parts of a URL

def lower_ascii(c: Column) -> Column:
    return F.translate(c, ascii_uppercase, ascii_lowercase)


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """Distinct tokens: scheme, top-level domain, words of the host, first path
    segment, shapes of all segments (digits as ``#``), query keys, fragment."""
    host, path = host_of(url), path_of(url)
    labels, segments = F.split(host, r"\."), F.filter(F.split(path, "/"), lambda x: x != "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)

    def tagged(tag: str, items: Column) -> Column:
        return F.transform(F.filter(items, lambda x: x != ""), lambda x: F.concat(F.lit(tag), x))

    found = F.concat(
        tagged("scheme:", F.array(lower_ascii(F.regexp_extract(url, r"(?s)^(.*?)://", 1)))),
        tagged("tld:", F.slice(labels, -1, 1)),
        tagged("host:", F.flatten(F.transform(F.slice(labels, 1, F.greatest(F.size(labels) - 1, F.lit(0))), lambda x: F.split(x, "-")))),
        tagged("first:", F.slice(segments, 1, 1)),
        tagged("shape:", F.transform(segments, lambda x: F.regexp_replace(x, "[0-9]+", "#"))),
        tagged("key:", F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))),
        F.when(url.contains("#"), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")))
    return F.when(url.contains("://"), F.array_distinct(found)).otherwise(F.array().cast("array<string>"))


# --------------------------------------------------------------------- given rules

def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame([(h + p, h, p, v) for h, p, v in rules], RULE)


def given(rows: DataFrame, rules: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``rows`` (host, path, and ``keep``) with ``rule`` and ``verdict`` of the
    longest rule that fits, both null where none does.

    Only as many of a host's endings are looked up as the rules have labels."""
    deepest = rules.agg(F.max(F.size(F.split("r_host", r"\.")))).first()[0] or 0
    rules, _ = small_table(rules)
    labels = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max(1, deepest)))),
                       lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."))
    cols = ["host", "path", *keep]
    one = rows.select(F.monotonically_increasing_id().alias("row"), *cols).withColumn("end", F.explode(ends))
    fits = (F.col("end") == F.col("r_host")) & F.col("path").startswith(F.col("r_path"))
    rank = F.when(F.col("rule").isNotNull(), F.struct(
        F.length("rule").alias("n"), F.length("r_host").alias("h"), (F.col("verdict") == "block").alias("b"), "rule", "verdict"))
    # the rows of a URL stand together, so they are one before the exchange
    best = one.join(rules, fits, "left").groupBy("row").agg(*[F.first(c).alias(c) for c in cols], F.max(rank).alias("best"))
    return best.select(*cols, "best.rule", "best.verdict")


# ------------------------------------------------------------------- learned rules

def learn(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_rows: int = MIN_ROWS,
          min_confidence: float = MIN_CONFIDENCE) -> DataFrame | None:
    """Rules (tokens, verdict, confidence, support, posted) from (tokens, verdict)
    rows, written to the shared folder; None without labelled rows.

    ``support`` is the share of labelled rows that hold the tokens and the label,
    ``posted`` the rarest of the tokens among them."""
    labelled = labelled.where(F.col("verdict").isNotNull() & F.col("tokens").isNotNull())
    n = labelled.count()
    if n == 0:
        return None
    # labels are marked by a sign that no token starts with
    items = labelled.select(F.array_union(F.col("tokens"), F.array(F.concat(F.lit("="), F.col("verdict")))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(min_support, min_rows / n)), minConfidence=min_confidence).fit(items)
    one = F.col("consequent")[0]
    rules = model.associationRules.where(one.startswith("=")).select(
        F.array_sort("antecedent").alias("tokens"), F.substring(one, 2, 1 << 20).alias("verdict"), "confidence", "support")
    rules = cut_lineage(rules, "mined")
    wider = rules.select(F.col("tokens").alias("__t"), F.col("verdict").alias("__v"), F.col("confidence").alias("__c"))
    less = rules.select("tokens", "verdict", "confidence", F.explode(F.transform(
        "tokens", lambda x: F.array_remove("tokens", x))).alias("fewer"))
    idle = less.join(wider, (F.col("fewer") == F.col("__t")) & (F.col("verdict") == F.col("__v")) & (F.col("__c") >= F.col("confidence")))
    rules = rules.join(idle.select("tokens", "verdict"), ["tokens", "verdict"], "left_anti")
    often = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    posted = (rules.select("*", F.explode("tokens").alias("token")).join(often, "token")
              .groupBy("tokens", "verdict").agg(F.min(F.struct("freq", "token")).alias("least"),
                                                F.first("confidence").alias("confidence"), F.first("support").alias("support")))
    return cut_lineage(posted.select("tokens", "verdict", "confidence", "support", F.col("least.token").alias("posted")), "rules")


def learned(rows: DataFrame, rules: DataFrame | None, keep: Sequence[str], default: str) -> DataFrame:
    """``rows`` (tokens, and ``keep``) with ``verdict``, the deciding rule's
    tokens as ``mined`` and its ``confidence``; both null for the default."""
    if rules is None:
        return rows.select(*keep, F.lit(default).alias("verdict"), F.lit(None).cast("array<string>").alias("mined"),
                           F.lit(None).cast("double").alias("confidence"))
    index, _ = small_table(rules.select(F.col("tokens").alias("need"), "verdict", "confidence", "support", "posted"))
    one = rows.select(F.monotonically_increasing_id().alias("row"), "tokens", *keep).withColumn("token", F.explode_outer("tokens"))
    fits = (F.col("token") == F.col("posted")) & (F.size(F.array_except("need", "tokens")) == 0)
    rank = F.when(F.col("posted").isNotNull(), F.struct(
        (-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), (F.col("verdict") != "block").alias("a"),
        "need", "verdict", "confidence"))
    best = one.join(index, fits, "left").groupBy("row").agg(*[F.first(c).alias(c) for c in keep], F.min(rank).alias("best"))
    return best.select(*keep, F.coalesce("best.verdict", F.lit(default)).alias("verdict"), F.col("best.need").alias("mined"), "best.confidence")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], default: str = "allow", id_col: str = "page_id",
          url_col: str = "url", **mining) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined, confidence) of every row.

    The URLs that the given rules decide are the labelled ones."""
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"),
                        tokens_of(F.coalesce(url, F.lit(""))).alias("tokens"))
    seen = cut_lineage(given(rows, rule_table(pages.sparkSession, rules), ["page_id", "tokens"]), "given")
    found = learn(seen.where(F.col("rule").isNotNull()).select("tokens", "verdict"), **mining)
    keep = ["page_id", "host", "path", "rule"]
    rest = learned(seen.where(F.col("rule").isNull()), found, keep, default)
    sure = seen.where(F.col("rule").isNotNull()).select(*keep, "verdict", F.lit(None).cast("array<string>").alias("mined"),
                                                        F.lit(None).cast("double").alias("confidence"))
    return sure.unionByName(rest)
