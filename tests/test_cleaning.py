"""Cleaning rules on literal values."""

import math

import pytest
from pyspark.sql import functions as F

from wareloom.functions import text, urls
from wareloom.sources import seeds


def apply(spark, values, rule, kind="string"):
    frame = spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"n int, v {kind}")
    return [row.out for row in frame.select("n", rule(F.col("v")).alias("out")).orderBy("n").collect()]


def test_text_price(spark):
    cases = {
        "$14.95": 14.95, "$1,299.00": 1299.0, "1.299,00": 1.299, "-5": 5.0, "Rs.500": 0.5, "5.": 5.0,
        "$10.00 – $20.00": None, "N/A": None, "N/A (Parse Error)": None, "": None, ".": None, "٣.٥": 3.5,
        "１２": 12.0, None: None,
    }
    assert apply(spark, list(cases), text.text_price) == list(cases.values())


def test_numeric_price_keeps_its_sign(spark):
    assert apply(spark, [-5.0, 0.0, math.nan, None], text.numeric_price, "double") == [-5.0, 0.0, None, None]


def test_price_rule_follows_the_column_type(spark):
    assert apply(spark, [1.0e7], lambda c: text.clean_price(c, "double"), "double") == [1.0e7]
    assert apply(spark, ["1.0E7"], lambda c: text.clean_price(c, "string")) == [1.07]


def test_availability(spark):
    labels = ["Available", "AVAILABLE", " available", "Out of Stock", "", None]
    assert apply(spark, labels, text.availability_flag) == [1, 1, 0, 0, 0, 0]


def test_strip_html(spark):
    cases = {
        "<p>Hi <b>x</b></p>": "Hi x", "a<b\nc>d": "a<b\nc>d", "a<b\rc>d": "ad", "\u00a0x\u00a0": "x",
        "&amp;": "&amp;", "<>": "", " \x1c\u3000<br> y ": "y", None: "",
    }
    assert apply(spark, list(cases), text.strip_html) == list(cases.values())


def test_fill_missing_creates_absent_columns(spark):
    frame = spark.createDataFrame([(None, ""), ("t", None)], "title string, sku string")
    rows = text.fill_missing(frame).orderBy("title").collect()
    assert [(r.title, r.sku, r.vendor) for r in rows] == [("N/A", "", "N/A"), ("t", "N/A", "N/A")]


def test_store_name(spark):
    cases = {
        "https://www.allbirds.com": "allbirds", "https://tattly.com": "tattly", "http://x.y": "http://x",
        "https://nodot": "nodot",
    }
    assert apply(spark, list(cases), urls.store_name) == list(cases.values())


def test_product_link(spark):
    out = apply(spark, ["h", "", None], lambda h: urls.product_link(F.lit("https://s.com"), h))
    assert out == ["https://s.com/products/h", "N/A", "N/A"]


def test_resolve_url_equals_urljoin(spark):
    """By built-in expressions alone, also where the standard library finds fault."""
    from urllib.parse import urljoin

    def wanted(base, link):
        try:
            return urljoin(base, link)
        except ValueError:
            return link

    bases = ["https://h.com/a/b/c?q=1#f", "http://h.com", "//odd/base", "https://h.com/a/b/", "https://u:p@h.com:8080//x//y;z=1/w;v",
             "HTTPS://H.com/A", "mailto:a@b.c", "a/b", "file:///etc/x", "https://[::1]:80/a/b", "https://h.com?q", "\t https://h.com/\na/b ",
             "ws://h/a;b/c;d", "https:a/b", "https://h.com/../x", "https://h[.com/a", "", "/root/x", "https:///p/q", "https://h.com/é/b c"]
    links = ["/x/y", "/", "/x/../y", "x", "../x", "?p=2", "#top", "//other.com/z", "https://z.com/a/../b", "", "/a b", "/x//y",
             "mailto:a@b.c", "/x;p", "/é", ".", "..", "./", "../", "../../..", "../../../../x", "/..", "/.", "/a/./b/..", "a/../../b/./c/",
             "x;p?q#f", ";p", ";", "?", "#", "?#", "//", "///a", "//[::1]/x", "//[bad/x", "//a]b", "//[zz]/x", "https:", "https:x", "http:x",
             "https:/x", "HTTPS:../y", "a:b", "1:b", ":x", " /x ", "\n/x\ty", "x?a=/../b", "x#/../b", "/a;b/../c", "..;p", "/x/..;p/y",
             "a//b", "a//", "//o.com", "//o.com?x", "//o.com/../a;b?c#d#e", "x/.", "x/..", "...", "/.../x", "x?y?z", "javascript:void(0)"]
    rows = [(n, base, link) for n, (base, link) in enumerate((b, link) for b in bases for link in links)]
    frame = spark.createDataFrame([*rows, (9998, None, "x"), (9999, "https://h.com", None)], "n int, base string, link string")
    joined = frame.select("n", urls.resolve_url(F.col("base"), F.col("link")).alias("url"))
    assert "Python" not in joined._jdf.queryExecution().executedPlan().toString()
    got = {r.n: r.url for r in joined.collect()}
    assert [row for row in rows if got[row[0]] != wanted(*row[1:])] == []
    assert got[9998] is None and got[9999] is None


def test_seeds(spark):
    stores = seeds.store_seeds(spark).orderBy("seed_no").collect()
    assert [s.store for s in stores] == ["allbirds", "brooklinen", "untuckit", "tattly", "flowrette"]
    categories = seeds.category_seeds(spark).orderBy("seed_no").collect()
    assert [c.category for c in categories] == ["Version 1", "Version 2", "Mini", "Tallboy"]
