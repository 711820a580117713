import random

from shelfmark.llm import urls

RULES = "host string, path string, action string"


def brute(url, rules):
    if url is None or "://" not in url:
        rest = ""
    else:
        rest = url.split("://", 1)[1]
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: next((i for i, c in enumerate(path) if c in "?#"), len(path))]
    fits = [
        (len(h + p), a, h + p) for h, p, a in rules
        if (host == h or host.endswith("." + h) or h == "") and path.startswith(p)
    ]
    best = max(fits, default=(0, "allow", None))
    return host, path, best[2], best[1]


def test_equals_brute_force(spark):
    rng = random.Random(0)
    hosts = ["com", "a.com", "b.a.com", "A.B.com", "acom", "", "x..com", "user@a.com:80", "é.com"]
    paths = ["", "/", "/en", "/en/", "/en/x", "/EN/", "//", "/en?x=/de/", "?q", "#f", "/de/f/g.html#x://y"]
    rules = [(h, p, rng.choice(("allow", "block"))) for h in ("com", "a.com", "b.a.com", "", "x..com")
             for p in ("", "/", "/en", "/en/x", "/de/f")]
    chosen = rng.sample(rules, 14)
    seen = [f"{s}{h}{p}" for s in ("http://", "://", "ftp:", "") for h in hosts for p in paths] + [None, "", "a://b://c"]
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(seen)], "page_id long, url string")
    got = urls.judge_urls(frame, spark.createDataFrame(chosen, RULES)).collect()
    assert {r["page_id"]: tuple(r)[2:] for r in got} == {i: brute(u, chosen) for i, u in enumerate(seen)}


def test_precedence_and_edge_cases(spark):
    rules = [("a.com", "/x", "allow"), ("a.com", "/x", "block"), (None, "/", "block"), ("b.com", None, "block"),
             ("B.com", "/", "block")]
    rows = [(1, "http://a.com/xy"), (1, "http://a.com/xy"), (2, None), (None, "http://b.com/" + "p" * 300000), (3, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr(
        "*", "'mine' as Host", "1 as digest", "2 as prefix", "3 as best")
    got = urls.judge_urls(pages, spark.createDataFrame(rules, RULES)).collect()
    assert sorted([(r["page_id"], r["rule"], r["verdict"]) for r in got], key=str) == sorted(
        [(1, "a.com/x", "block"), (1, "a.com/x", "block"), (2, None, "allow"), (None, "b.com/", "block"),
         (3, None, "allow")], key=str)
    none = spark.createDataFrame([], RULES)
    assert {r["verdict"] for r in urls.judge_urls(pages, none, default="block").collect()} == {"block"}
    assert urls.judge_urls(pages.where("false"), none).count() == 0
