"""URL rules against a plain reading, the model against plain gradient descent and held-out rows."""

import math
import re

from conftest import SF_SMALL
from pyspark.sql import functions as F

from corpusprep.llm import queries, url_filter

URLS = [None, "", "no scheme.com/x", "http://", "https://EXAMPLE.com/EN/a?b#c", "x://www.example.com/en/", "https://example.net/es/1", "http://a.b.net/fr", "ftp://net/fr/x://y/z",
        "https://example.com", "https://example.com?q=/en/", "https://notexample.com/en/", "https://sub.www.example.com/en/q", "://host/p", "https://com/", "h://x.org:80/%20 é#",
        "https://" + "a" * 50_000 + ".org/" + "b/" * 30_000, "https://É.org/ß", "http://a.org\n/x"]


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), re.match(r"[^?#]*", rest[len(host):]).group()


def rule_of(host, path, rules):
    fits = []
    for verdict, rule in rules:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append((-len(rule), rule, verdict))
    return min(fits, default=(0, None, None))[1:]


def test_rules_equal_a_plain_reading(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("url").unionByName(spark.createDataFrame([(u,) for u in URLS], "url string"))
    pages = pages.withColumns({"host": F.lit(1), "rule": F.lit(2), "score": F.lit("clash"), "x": F.lit(0)})
    rows = url_filter.filter_urls(pages, queries.URL_RULES, url_filter.labelled_table(spark)).collect()
    assert len(rows) == pages.count()
    for r in rows:
        host, path = host_path(r["url"])
        rule, verdict = rule_of(host, path, queries.URL_RULES)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["score"] > 0.5 else "allow")) and 0 <= r["score"] <= 1


def features(spark, df):
    host, path = url_filter.host_and_path(F.col("url"))
    return df.select("*", url_filter.features(host, path).alias("x"))


def test_model_equals_plain_gradient_descent(spark):
    table = url_filter.labelled_table(spark)
    rows = [(r["x"], int(r["blocked"])) for r in features(spark, table.distinct()).collect()]
    counts = {y: sum(1 for _, z in rows if z == y) for y in (0, 1)}
    weights, squares = [0.0] * (url_filter.BUCKETS + 1), [0.0] * (url_filter.BUCKETS + 1)
    for _ in range(3):
        gradient = {}
        for x, y in rows:
            root = math.sqrt(max(len(x), 1))
            pull = (1 / (1 + math.exp(-(weights[0] + sum(weights[i + 1] for i in x) / root))) - y) / (2 * counts[y])
            for i, g in [(0, pull)] + [(i + 1, pull / root) for i in x]:
                gradient[i] = gradient.get(i, 0) + round(g * url_filter.UNIT)
        for i, g in gradient.items():
            g /= url_filter.UNIT
            squares[i] += g * g
            weights[i] -= (0.3 if i else 0.03) * g / (math.sqrt(squares[i]) + 1e-6)
    got = url_filter.train(table, steps=3)
    assert max(abs(a - b) for a, b in zip(got, weights)) < 1e-4


def test_held_out_accuracy(spark):
    table = url_filter.labelled_table(spark).withColumn("held", F.pmod(F.xxhash64("url"), F.lit(5)) == 0)
    out = url_filter.filter_urls(table.filter("held"), [], table.filter("NOT held")).collect()
    blocked = [r["verdict"] == "block" for r in out if r["blocked"]]
    allowed = [r["verdict"] == "allow" for r in out if not r["blocked"]]
    assert sum(blocked) / len(blocked) >= 0.4 and sum(allowed) / len(allowed) >= 0.95


def test_without_both_classes_and_on_nothing(spark):
    pages = spark.createDataFrame([("https://casino.org/x",), ("https://net/es/",)], "url string")
    one = spark.createDataFrame([("https://casino.org/x", True), (None, False), ("u", None)], "url string, blocked boolean")
    assert sorted(r["verdict"] for r in url_filter.filter_urls(pages, queries.URL_RULES, one).collect()) == ["allow", "block"]
    assert url_filter.filter_urls(pages.limit(0), [], url_filter.labelled_table(spark)).collect() == []


def test_native_plan(spark):
    plan = queries.QUERIES["op12_url_filter"](spark, SF_SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
