from corpusloom.llm import url_filter as U
from corpusloom.llm.queries import RULES


def naive(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        n = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:n])
        m = min([rest.index(c, n) for c in "?#" if c in rest[n:]], default=len(rest))
        path = rest[n:m]
    fits = [(len(h) + len(p), len(h), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *((max(fits)[3], max(fits)[2]) if fits else (None, default)))


URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.org/es/1", "http://example.org", "https://a.b.example.org/en/19?x#y", "http://notexample.org/es/",
    "http://x.com/fr/", "http://x.com/de", "http://com/de/", "http://org?/es/", "ftp://É.Org/x://y", "http://" + "a." * 500 + "com/de/" + "z" * 5000,
    "http://example.org/en/1", "http://example.org/EN/1", "http://example.org:80/es/", "http://x.com#/fr/", "http://.com/fr/x", "http://x.com/fr/x",
]


def test_verdicts(spark):
    rows = [(i, u, "clash") for i, u in enumerate(URLS * 2)]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = U.filter_urls(df, U.rules_table(spark, RULES)).select("page_id", "host", "path", "rule", "verdict").collect()
    want = [(i, *naive(u, RULES)) for i, u, _ in rows]
    assert sorted(map(tuple, got)) == sorted(want)


def test_longest_rule_and_ties(spark):
    rules = [("b.org", "", "block"), ("org", "/long/", "allow"), ("b.org", "/l", "allow"), ("org", "/x", "allow"), ("org", "/x", "block")]
    urls = ["http://a.b.org/long/1", "http://b.org/", "http://c.org/x1", "http://c.org/", "http://b.org/l"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in U.filter_urls(df, U.rules_table(spark, rules)).collect()}
    assert got == {0: ("org/long/", "allow"), 1: ("b.org", "block"), 2: ("org/x", "block"), 3: (None, "allow"), 4: ("b.org/l", "allow")}


def test_no_rules_and_no_rows(spark):
    df = spark.createDataFrame([(1, "http://x.org/")], "page_id long, url string")
    assert U.filter_urls(df, U.rules_table(spark, []), default="block").first().verdict == "block"
    assert U.filter_urls(df.limit(0), U.rules_table(spark, RULES)).count() == 0


def test_plan_is_native(spark):
    df = spark.createDataFrame([(1, "http://x.org/")], "page_id long, url string")
    plan = U.filter_urls(df, U.rules_table(spark, RULES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
