import re

from lexiflow.llm import queries, urls

from .conftest import SF

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "a.b.c"), ("allow", "c/x"), ("block", "c/x"), (None, "d/"), ("block", None)]


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    raw = re.match(r"[^/?#]*", rest)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), raw)
    path = re.match(r"[^?#]*", rest[len(raw):])[0]
    fits = []
    for action, rule in rules:
        if action and rule:
            h, slash, p = rule.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith(slash + p):
                fits.append((len(rule), action == "block", rule, action))
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else default


def test_matches_brute_force_on_the_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in queries.op7_url_filters(spark, SF).collect()}
    assert got == {p.page_id: brute(p.url, queries.URL_RULES) for p in pages}


def test_awkward_urls(spark):
    links = [None, "", "no scheme", "http://", "http://X.ORG", "http://x.org?q=/es/", "https://EXAMPLE.org/es/1#a", "x://org/",
             "http://notorg/", "http://.org/", "http://a.b.c", "http://z.a.b.c/x", "http://a.b.c:80/x", "http://c/xyz", "http://c/X",
             "a://b://c/x", "http://" + "a." * 3000 + "org/" + "p" * 50000, "http://Ünï.org/é", "http://example.org/es"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(links)] + [(1, "http://c/xyz", "z"), (None, "http://c/xyz", "z")],
                                  "page_id long, url string, host string")
    rules = spark.createDataFrame(RULES, "action string, rule string")
    key = lambda r: tuple(map(str, r))
    want = sorted(((p.page_id, *brute(p.url, RULES)) for p in pages.collect()), key=key)
    assert sorted((tuple(r) for r in urls.url_verdicts(pages, rules).collect()), key=key) == want
    assert urls.url_verdicts(pages.limit(0), rules).collect() == []
    assert {r.verdict for r in urls.url_verdicts(pages, rules.limit(0), default="block").collect()} == {"block"}


def test_only_spark_functions(spark):
    plan = queries.op7_url_filters(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
