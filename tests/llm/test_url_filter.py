"""Rules against a plain reading of them, and the trees by held-out accuracy."""

import math

from pyspark.sql import functions as F

from orderlake.llm import url_filter
from orderlake.llm.queries import QUERIES, URL_RULES


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]


def rule_for(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


URLS = [None, "", "no scheme/net/", "http://net/", "http://net", "http://NET/x", "https://a.example.net/en/1?q=/de/", "http://example.net/en", "http://xnet/"]
URLS += ["http://example.com/de/1", "http://shop.example.com/de", "http://myexample.com/de/x", "http://a.org/fr/x#y", "http://a.org/frx", "http://ÄB.net/ü"]
URLS += ["ftp://a://b.net/c", "http://?x", "http://a.b/c?d=1&e=2#f", "http://a.net?x=/", "http://a\n.net/b\nc", "x" * 5000 + "://y.net/", "http://" + "a." * 2000 + "net/"]


def test_host_path_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "v", "h") for i, u in enumerate(URLS)] + [(0, None, "v", "h")], "page_id long, url string, verdict string, u string")
    out = url_filter.judge(pages, URL_RULES)
    assert out.columns == ["page_id", "url", "u", "host", "path", "rule", "verdict", "block_probability"]
    rows = out.collect()
    assert len(rows) == len(URLS) + 1
    for r in rows:
        host, path = parts(r.url)
        rule = rule_for(host, path, URL_RULES)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.text), r.url
        assert r.verdict == rule.verdict if rule else r.verdict in ("allow", "block")


def test_entropy_and_counts(spark):
    df = spark.createDataFrame([("http://a1.b/cc?x=1&y=2",), ("",)], "url string")
    df = df.withColumns({"host": url_filter.host_of(F.col("url")), "path": url_filter.path_of(F.col("url"))})
    a, b = df.select(*[c.alias(n) for n, c in url_filter.lexical_features(F.col("url"), F.col("host"), F.col("path")).items()]).collect()
    text = "http://a1.b/cc?x=1&y=2"
    assert abs(a.f_entropy + sum(text.count(c) / len(text) * math.log2(text.count(c) / len(text)) for c in set(text))) < 1e-9
    assert (a.f_length, a.f_depth, a.f_parameters, a.f_host_length) == (len(text), 1, 2, 4)
    assert a.f_digit_ratio == 3 / len(text) and b.f_entropy == 0 and b.f_length == 0


def test_trees_learn_from_labelled_urls(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    # Truth that only the characters tell: many digits or a parameter.
    truth = (F.regexp_count("url", F.lit("[0-9]")) >= 4) | F.contains("url", F.lit("page="))
    known = pages.withColumn("label", truth.cast("int"))
    seen, rest = known.where("page_id % 3 > 0"), known.where("page_id % 3 = 0")
    out = url_filter.judge(rest, [], labelled=seen.select("url", "label"))
    share = out.agg(F.avg(((F.col("verdict") == "block").cast("int") == F.col("label")).cast("int"))).head()[0]
    assert share > 0.95


def test_a_hot_url_neither_fills_the_sample_nor_leaves_it(spark, monkeypatch):
    class Trees:
        def __init__(self, weightCol=None, **_):
            self.weight = weightCol

        def fit(self, ready):
            weight = F.col(self.weight) if self.weight else F.lit(1.0)
            self.rows = ready.select("label", weight.alias("w")).collect()
            return self

    monkeypatch.setattr(url_filter, "GBTClassifier", Trees)
    others = [(f"http://h{i}.net/{'x' * (i % 97)}{i}", 0) for i in range(4000)]
    for n in range(6):
        # One URL on a third of the rows, and all that is blocked.
        known = spark.createDataFrame([(f"http://hot.com/{n}", 1)] * 2000 + others, "url string, label int")
        known = known.withColumns({"host": url_filter.host_of(F.col("url")), "path": url_filter.path_of(F.col("url"))})
        rows = url_filter.fit(known, max_rows=400).trees.rows
        assert len(rows) <= 480
        assert [r.w for r in rows if r.label == 1] == [2000]
        assert abs(sum(r.w for r in rows if r.label == 0) - 4000) < 1600


def test_nothing_to_learn(spark):
    pages = spark.createDataFrame([(1, "http://a.b/")], "page_id long, url string")
    assert url_filter.judge(pages, URL_RULES).head().verdict == "allow"
    only = spark.createDataFrame([("http://c.d/", 1), (None, 1)], "url string, label int")
    assert url_filter.judge(pages, [], labelled=only).head().verdict == "block"
    assert url_filter.judge(pages.limit(0), URL_RULES).count() == 0


def test_query_is_native_and_whole(spark):
    sf = "/root/testdata/sf0.01"
    out = QUERIES["op10_url_filter"](spark, sf)
    plan = out._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
    rows = out.collect()
    assert len(rows) == spark.read.parquet(f"{sf}/pages.parquet").count()
    for r in rows:
        rule = rule_for(r.host, r.path, URL_RULES)
        assert r.rule == (rule and rule.text) and r.verdict == (rule.verdict if rule else "block" if r.block_probability >= 0.5 else "allow")
