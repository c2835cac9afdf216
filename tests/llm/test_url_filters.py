"""Rules by sweep against testing every rule on every URL."""
import random
import re

from finmesh.llm import url_filters as U


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host):])[0]


def brute(url, rules):
    host, path = parts(url)
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


def test_fixed_cases(spark):
    urls = ["http://NET/", "https://a.net/x?y", "http://a.net", "http://example.net/en/1", "http://x.example.net/en", "http://badexample.net/en/", "http://a.example.com/de/#f",
            "http://example.com/de", "ftp://w.org/fr/q", "http://net.org/", "nothing", None, "", "://", "http:///net/", "http://a.b.example.com?x=/de/", "http://example.net./en/",
            "http://é.net/", "http://a://net/", "HTTP://Example.COM/de/"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge(df, U.rules_frame(spark)).collect()}
    assert got == {i: brute(u, U.RULES) for i, u in enumerate(urls)}


def test_random_nested_rules(spark):
    rng, labels = random.Random(4), ["a", "b", "c-d", "com", "net", "x1"]
    host = lambda n: ".".join(rng.choices(labels, k=rng.randint(1, n)))
    rules = list({(host(3), rng.choice(["", "/", "/p/", "/p/q"]), rng.choice(["allow", "block"])) for _ in range(60)})
    rules = list({(h, p): (h, p, v) for h, p, v in rules}.values())
    urls = [f"http://{host(5)}{rng.choice(['', '/', '/p/', '/p/q/r', '/z'])}" for _ in range(800)]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").repartition(6)
    frame = U.rules_frame(spark, rules + rules[:5] + [(None, "/", "block"), ("", "/", "block")])
    got = {r.page_id: (r.rule, r.verdict) for r in U.judge(df, frame).collect()}
    for i, u in enumerate(urls):
        assert got[i] == brute(u, rules)[2:], u


def test_repeats_clashes_and_empty(spark):
    df = spark.createDataFrame([(1, "http://a.net/", "h", "p"), (1, "http://a.net/", "h", "p"), (None, None, None, None)], "page_id long, url string, host string, stack string")
    got = U.judge(df, U.rules_frame(spark)).collect()
    assert sorted((r.page_id or 0, r.verdict) for r in got) == [(0, "allow"), (1, "block"), (1, "block")]
    assert U.judge(df.limit(0), U.rules_frame(spark)).collect() == []
    assert {r.verdict for r in U.judge(df, U.rules_frame(spark).limit(0)).collect()} == {"allow"}
