"""URL rules against a plain reading of the URL and enumerated combinations."""

import re
from itertools import combinations

from pyspark.sql import functions as F

from penmark.llm import urlrules
from penmark.llm.queries import QUERIES, URL_RULES
from tests.conftest import SF_MID


def frame(spark, urls):
    return spark.createDataFrame([(i, u, "h", "p", "r", "v", 1, "t") for i, u in enumerate(urls)],
                                 "page_id long, url string, host string, path string, rule string, verdict string, row int, tokens string")


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = re.split(r"[?#]", url.split("://", 1)[1])[0]
    host, slash, path = rest.partition("/")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path


def fixed(host, path, rules=URL_RULES):
    fit = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[3:] if fit else (None, None)


def enumerated(rows, min_support, min_rows, min_confidence):
    """Pruned rules from every combination of every labelled row's tokens."""
    count, labelled = {}, {}
    for tokens, verdict in rows:
        for n in range(1, len(tokens) + 1):
            for c in combinations(sorted(tokens), n):
                count[c] = count.get(c, 0) + 1
                labelled[c, verdict] = labelled.get((c, verdict), 0) + 1
    least = max(min_support * len(rows), min_rows)
    sure = {(c, v): n / count[c] for (c, v), n in labelled.items() if n >= least and n / count[c] >= min_confidence}
    return {(c, v): (p, labelled[c, v] / len(rows)) for (c, v), p in sure.items()
            if not any(sure.get((c[:i] + c[i + 1:], v), 0) >= p for i in range(len(c)))}


def test_registered_query_against_brute_force(spark):
    got = {r["page_id"]: r for r in QUERIES["op13_url_rules"](spark, SF_MID).collect()}
    pages = spark.read.parquet(f"{SF_MID}/pages.parquet").select(
        "page_id", "url", urlrules.tokens_of(F.coalesce("url", F.lit(""))).alias("tokens")).collect()
    assert len(got) == len(pages)
    want = {p["page_id"]: (*split(p["url"]), *fixed(*split(p["url"]))) for p in pages}
    rules = enumerated([(p["tokens"], want[p["page_id"]][3]) for p in pages if want[p["page_id"]][2]],
                       urlrules.MIN_SUPPORT, urlrules.MIN_ROWS, urlrules.MIN_CONFIDENCE)
    assert rules
    learned = 0
    for p in pages:
        host, path, rule, verdict = want[p["page_id"]]
        if rule is None:
            fit = sorted((-c, -s, v != "block", t, v) for (t, v), (c, s) in rules.items() if set(t) <= set(p["tokens"]))
            verdict = fit[0][4] if fit else "allow"
            learned += bool(fit)
            assert (got[p["page_id"]]["mined"] or None) == (" ".join(fit[0][3]) if fit else None)
        r = got[p["page_id"]]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict), p["url"]
    assert learned > 10


def test_edges(spark):
    urls = [None, "", "no scheme/en/", "http://", "http://com", "http://com/", "http://COM/x", "http://a.b.com?x=/en/",
            "http://example.com/en/", "http://www.example.com/en/1", "http://WWW.Example.com/en", "http://xexample.com/en/",
            "http://www.example.com:80/en/", "x://É.net/es/a?b#c", "http://net/fr/", "http://net/fr", "a://b://c.net/es/",
            "http://com./x", "http://example.com/en/" + "a/" * 20000, "http://" + "a." * 5000 + "net/es/", "http://u.org/?a=1&a=2&=&b#f#g",
            "http://line\nbreak.com/x\ny", "http://com/", "http://com/"]
    out = urlrules.judge(frame(spark, urls), URL_RULES)
    assert out.columns == ["page_id", "host", "path", "rule", "verdict", "mined", "confidence"]
    got = {r["page_id"]: r for r in out.collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        host, path = split(u)
        rule, verdict = fixed(host, path)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == (host, path, rule, verdict or "allow"), u
    assert urlrules.judge(frame(spark, urls).limit(0), URL_RULES).count() == 0
    alone = urlrules.judge(frame(spark, ["http://q.org/a", None]), URL_RULES, default="block").collect()
    assert [r["verdict"] for r in alone] == ["block", "block"]


def test_learned_rules_generalise(spark):
    urls = [f"http://h{i % 9}.net/{'es' if i % 2 else 'zz'}/{i}" for i in range(200)] + [f"http://h{i % 9}.com/{'qq'}/{i}" for i in range(200)]
    rows = urlrules.judge(frame(spark, [*urls, "http://new.org/es/5", "http://new.org/qq/5", "http://new.org/vv/5"]), URL_RULES)
    got = {r["page_id"]: r for r in rows.where("page_id >= 400").collect()}
    assert (got[400]["verdict"], got[400]["mined"]) == ("block", ["first:es"])
    assert (got[401]["verdict"], got[401]["mined"]) == ("allow", ["first:qq"])
    assert (got[402]["verdict"], got[402]["mined"]) == ("allow", None)


def test_ties_of_given_rules(spark):
    rules = [("x.com", "/ab/", "allow"), ("com", "/ab/cd", "block"), ("org", "/", "allow"), ("org", "/", "block")]
    assert len("x.com/ab/") == len("com/ab/cd")
    out = urlrules.judge(frame(spark, ["http://x.com/ab/cde", "http://y.org/"]), rules).orderBy("page_id").collect()
    assert [(r["rule"], r["verdict"]) for r in out] == [("x.com/ab/", "allow"), ("org/", "block")]
