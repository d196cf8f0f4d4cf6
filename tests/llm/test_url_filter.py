"""Hosts, paths and rules against plain Python; the trees on URLs without a rule."""

import os
import random
import re

from pyspark.sql import functions as F

from wareloom.llm import url_filter
from wareloom.llm.queries import LLM_QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
RULES = dict(url_filter.RULES)


def plain(url):
    _, found, rest = (url or "").partition("://")
    host = re.match(r"[^/?#]*", rest)[0] if found else ""
    path = re.match(r"[^?#]*", rest[len(host):])[0] if found else ""
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [rule for rule in RULES
            if (host == rule.split("/")[0] or host.endswith("." + rule.split("/")[0])) and path.startswith(rule[rule.index("/"):])]
    return host, path, max(fits, key=len) if fits else None


def check(given, got):
    assert sorted(map(str, ((r.page_id, r.host, r.path, r.rule) for r in got))) == sorted(
        str((page_id, *plain(url))) for page_id, url in given)
    for row in got:
        assert row.verdict in ("allow", "block")
        assert row.rule is None or row.verdict == RULES[row.rule]


def pages(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")


def test_query(spark):
    given = [(r.page_id, r.url) for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()]
    check(given, LLM_QUERIES["op7_url_filter"](spark, SF_DIR).collect())


ODD = [
    None, "", "no scheme", "http://", "HTTP://A.NET/X", "x://net", "x://net/", "x://notnet/", "x://a.example.net/en", "x://a.example.net/en/1",
    "x://example.com/de/?q://y", "x://example.com?/de/", "x://example.com#/de/", "x://org/fr/", "x://İ.ORG/fr/", "a\nb://c\nd/e\nf?g", "x://a.b:80/",
    "x://u@net/p", "x://" + "a" * 50_000 + ".net/" + "b/" * 9000, "http://a.org//fr/", "x://example.net./en/", "://net/",
]


def test_odd_urls_repeats_and_clashing_columns(spark):
    docs = pages(spark, ODD + ODD[:5])
    for name in ("host", "path", "rule", "verdict", "score", "label", "features", "_suffix", "f_length"):
        docs = docs.withColumn(name, F.lit("own"))
    docs = docs.unionByName(docs.where("page_id < 3").withColumn("page_id", F.lit(None).cast("long")))
    check([(r.page_id, r.url) for r in docs.collect()], url_filter.judge(docs).collect())


def made_urls(sites, top):
    """URLs with their verdicts: those with several parameters or many digits are blocked, whatever their site."""
    draw = random.Random(top)
    urls = []
    for n in range(sites * 20):
        blocked = draw.random() < 0.5
        digits = blocked and draw.random() < 0.5
        name = "".join(draw.choice("0123456789" if digits else "abcdefgh") for _ in range(14))
        query = "?" + "&".join(f"k{k}=v" for k in range(4)) if blocked and not digits else draw.choice(["", "?k=v"])
        urls.append((f"http://www.site{n % sites}.example.{top}/{draw.choice(['a', 'b', 'c'])}/{name}{query}", "block" if blocked else "allow"))
    return urls


def test_trees_judge_suffixes_that_they_never_saw(spark):
    """Learnt on one top-level domain, right on the sites of another."""
    labelled = spark.createDataFrame(made_urls(40, "io"), "url string, verdict string")
    unseen = made_urls(30, "dev")
    got = url_filter.judge(pages(spark, [url for url, _ in unseen]), labelled=labelled).collect()
    right = sum(r.verdict == unseen[r.page_id][1] for r in got)
    assert len(got) == len(unseen) and right >= 0.9 * len(unseen)


def test_rules_teach_more_than_the_top_level_domain(spark):
    """By the rules net is blocked but for short paths; others follow the length of the path, not their domain."""
    urls = [f"http://host{n}.example.net/{'en/' if n % 2 else 'de/' + 'x' * 30}{n}" for n in range(400)]
    urls += [f"http://other{n}.example.io/{'ab/' if n % 2 else 'cd/' + 'x' * 30}{n}" for n in range(50)]
    got = url_filter.judge(pages(spark, urls)).collect()
    assert {r.page_id % 2: r.verdict for r in got if r.rule is None} == {0: "block", 1: "allow"}
    assert len({(r.page_id % 2, r.verdict) for r in got if r.rule is None}) == 2
    assert all(r.rule == ("example.net/en/" if r.page_id % 2 else "net/") for r in got if r.rule)


def test_repeated_and_contradicting_labels(spark):
    labelled = spark.createDataFrame(
        [("http://a.b.io/x", "block"), ("http://a.b.io/x", "allow"), ("http://a.b.io/y", None), (None, None)] * 3, "url string, verdict string")
    assert {r.verdict for r in url_filter.judge(pages(spark, ["http://q.io/x", None]), labelled=labelled).collect()} == {"block"}


def test_without_rules_or_with_one_verdict(spark):
    urls = ["http://a.io/x", "http://b.io/y"]
    assert {r.verdict for r in url_filter.judge(pages(spark, urls)).collect()} == {"allow"}
    assert {r.verdict for r in url_filter.judge(pages(spark, [*urls, "http://a.net/"])).collect()} == {"block"}


def test_empty_table(spark):
    assert url_filter.judge(pages(spark, ["x"]).limit(0)).count() == 0


def test_lexical_features(spark):
    rows = pages(spark, ["http://a-b.example.org/en/12?x=1&y=2#z"]).select(
        "url", url_filter.host_of(F.col("url")).alias("host"), url_filter.path_of(F.col("url")).alias("path"))
    row = url_filter.lexical(rows).first()
    assert (row.f_depth, row.f_labels, row.f_parameters, row.f_hyphens, row.f_fragment) == (2, 3, 2, 1, 1)
    assert (row._suffix, row.f_segment) == ("a-b.example.org", 2)
    from collections import Counter
    from math import log2
    shares = [n / len(row.url) for n in Counter(row.url).values()]
    assert abs(row.f_entropy + sum(p * log2(p) for p in shares)) < 1e-9
