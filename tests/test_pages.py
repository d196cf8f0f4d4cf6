"""Page extraction, links and pagination on literal markup."""

import random

import pytest
from pyspark.sql import functions as F

from wareloom import schemas
from wareloom.functions import html
from wareloom.plans import ingest
from wareloom.sources import pages

AMOUNT = '<span class="woocommerce-Price-amount amount">'


def fields(spark, markup, rules=html.PRODUCT_RULES):
    frame = spark.createDataFrame([("u", markup, 0)], schemas.CAPTURED_PAGES)
    return pages.product_fields(pages.page_contents(frame, rules)).first()


def test_product_fields(spark):
    row = fields(spark, f"""
        <h1 class="entry-title product_title big">  Red <b>cap</b>&amp;co <!-- no --> </h1>
        <p class="price">{AMOUNT}<bdi>$9</bdi></span> {AMOUNT}<bdi> <i>$</i>7 </bdi></span></p>
        <span class="tagged_as">Tag: <a href="x" rel="nofollow">no</a><a rel="tag">mini</a><a rel="tag">two</a></span>
        SKU: <span class="sku">A-1</span><span class="sku">A-2</span>""")
    assert (row.title, row.price, row.tag, row.sku) == ("Red cap&co", "$7", "mini", "A-1")


@pytest.mark.parametrize("markup, price", [
    (f"{AMOUNT}<bdi>$5</bdi></span>", "$5"),
    (f'<p class="price">{AMOUNT} $4\n <b>only</b></span></p>', "$4 only"),
    (f"<div>{AMOUNT}$4</span></div>", "N/A"),
    ("", "N/A"),
    (f"{AMOUNT}<bdi></bdi></span>", ""),
])
def test_price_element(spark, markup, price):
    row = fields(spark, markup)
    assert (row.price, row.title, row.tag, row.sku) == (price, "N/A", "N/A", "N/A")


def test_broken_markup(spark):
    rules = {"v": [("div > p.a", 0), ("em", 0)]}
    assert fields(spark, '<div><span><p class="a">x</div></p><em>y', rules).v == "y"
    assert fields(spark, '<div><p class="a b">x<br>y<p class="a">z</div>w', rules).v == "xy"
    assert fields(spark, '<script>"<em>no</em>"</script></em><EM>yes', rules).v == "yes"
    assert fields(spark, "<em/>n<em>m</em>", rules).v == ""


def test_parse_failure_marks_all_fields(monkeypatch):
    monkeypatch.setattr(html.Outline, "feed", lambda self, text: 1 / 0)
    item = html.compile_selector("p")
    links, following, read = html.read_page("<p>", html._compile_rules(html.PRODUCT_RULES), item, [item], [item])
    assert (links, following, set(read.values())) == ([], None, {schemas.PARSE_ERROR})


def test_unavailable_page_gives_no_row(spark):
    frame = spark.createDataFrame([("u", None, 0), ("v", "", 0)], schemas.CAPTURED_PAGES)
    assert [(r.url, r.title) for r in pages.product_fields(pages.page_contents(frame)).collect()] == [("v", "N/A")]


def listing(links, following=None):
    items = "".join(f'<div class="product-small box">{link}</div>' for link in links)
    tail = f'<a class="next page-numbers" href="{following}">next</a>' if following else ""
    return f"<html>{items}{tail}</html>"


def test_listing_links(spark):
    markup = listing([
        '<a href="#q">q</a><a class="woocommerce-LoopProduct-link" href="/p/1">1</a>',
        '<a href="#q">q</a><p class="name product-title"><a href="../p/2">2</a></p>',
        '<a href="//o.com/p/3">3</a>', "<b>none</b>", '<a class="woocommerce-LoopProduct-link">no href</a>',
        '<p class="name product-title"><b><a href="/nested">x</a></b></p>',
    ], "?page=2")
    frame = spark.createDataFrame([("https://s.com/c/all/", markup, 0), ("https://s.com/about", "<a href='/x'>x</a>", 0)],
                                  schemas.CAPTURED_PAGES)
    outline = pages.listing_outline(pages.page_contents(frame))
    (row,) = outline.collect()
    assert [r.link for r in pages.link_rows(outline).orderBy("pos").collect()] == [
        "https://s.com/p/1", "https://s.com/c/p/2", "https://o.com/p/3", "https://s.com/nested"]
    assert row.next_url == "https://s.com/c/all/?page=2"


def test_page_is_parsed_once(spark):
    frame = spark.createDataFrame([("u", "", 0)], schemas.CAPTURED_PAGES)
    contents = pages.latest_captures(pages.page_contents(frame))
    result = pages.product_fields(contents).where("title > 'a' and price > 'b'")
    assert result._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_class_spelled_with_a_reference_is_found(spark):
    markup = '<div class="product&#45;small box"><a href="/p">p</a></div>'
    frame = spark.createDataFrame([("https://s.com/", markup, 0)], schemas.CAPTURED_PAGES)
    assert pages.listing_outline(pages.page_contents(frame)).first().links == ["/p"]


@pytest.mark.parametrize("markup, price", [
    (f'<p class="price">ask us<p>was {AMOUNT}$5</span>', "N/A"),
    (f'<p class="price"><b>{AMOUNT}$5</span></b><p>other', "$5"),
    (f'<p class="price"><span><div>{AMOUNT}$5</span></div>', "N/A"),
    (f'<p class="price"><button><p>x</p>{AMOUNT}$5</span></button>', "$5"),
])
def test_paragraphs_end_where_the_next_block_begins(spark, markup, price):
    assert fields(spark, markup).price == price


def test_implied_ends_of_lists_and_tables(spark):
    rules = {"li": [("li.a > b", 0)], "td": [("td.a b", 0)], "dd": [("dt b", 0)], "in": [("li.x li b", 0)], "o": [("option.a", 0)]}
    row = fields(spark, "<ul><li class=a>x<li><b>1</b></ul><table><tr><td class=a>x<td><b>2</b><tr><td>y</table>"
                        "<dl><dt>x<dd><b>3</b></dl><ul><li class=x><ul><li><b>4</b></ul></ul>"
                        "<select><option class=a>5<option>6</select>", rules)
    assert (row.li, row.td, row.dd, row["in"], row.o) == ("N/A", "N/A", "N/A", "4", "5")


def chain(spark, edges, start):
    edges = spark.createDataFrame(edges, "url string, next_url string")
    seeds = spark.createDataFrame([(0, "c", start)], schemas.CATEGORY_SEEDS)
    rows = pages.pagination_chain(edges, seeds).orderBy("hop").collect()
    return [r.page_url for r in rows]


def test_pagination(spark):
    assert chain(spark, [("p1", "p2"), ("p2", "p3")], "p1") == ["p1", "p2", "p3"]
    assert chain(spark, [("p1", "p2"), ("p2", "p1")], "p1") == ["p1", "p2"]
    assert chain(spark, [("p1", "p2"), ("p2", "p3"), ("p3", "p4"), ("p4", "p2")], "p1") == ["p1", "p2", "p3", "p4"]
    long = [(f"p{n}", f"p{n + 1}") for n in range(1, 75)]
    assert chain(spark, long, "p1") == [f"p{n}" for n in range(1, 76)]


def walked_one_by_one(steps, start):
    seen = [start]
    while steps.get(seen[-1]) not in (None, *seen):
        seen.append(steps[seen[-1]])
    return seen


@pytest.mark.parametrize("seed, limit", [(1, None), (2, None), (3, 4), (4, None)])
def test_pagination_equals_walking(spark, seed, limit):
    """Paths that run into each other, rings, rings entered from several sides, pages without an edge."""
    rng = random.Random(seed)
    n = 60
    edges = [(f"p{a:02}", f"p{(a + 1 if rng.random() < 0.7 else rng.randrange(n)) % n:02}") for a in range(n) if rng.random() < 0.95]
    edges = [(a, b) for a, b in edges if a != b] + [("p05", "p06"), ("p06", "p05")]
    steps = {}
    for a, b in edges:
        steps[a] = min(b, steps.get(a, b))
    seeds = [(k, f"c{k}", f"p{k % n:02}") for k in range(n + 5)] + [(99, "c99", "nowhere")]
    got = {}
    for r in pages.pagination_chain(
            spark.createDataFrame(edges, "url string, next_url string"), spark.createDataFrame(seeds, schemas.CATEGORY_SEEDS), limit).collect():
        got.setdefault(r.seed_no, {})[r.hop] = r.page_url
    wanted = {k: dict(enumerate(walked_one_by_one(steps, url)[:limit])) for k, _, url in seeds}
    assert got == wanted


def test_ranking_does_not_depend_on_seeds(spark):
    """Thousands of pages take as many rounds as their number has doublings, however many start points there are."""
    edges = spark.range(5000).select(F.concat(F.lit("p"), "id").alias("url"), F.concat(F.lit("p"), F.col("id") + 1).alias("next_url"))
    ranks, jumps = pages.rank_pages(edges)
    assert jumps.isEmpty() and ranks.count() == 5001
    assert ranks.where((F.col("rank") != 5000 - F.substring("url", 2, 9).cast("long")) | (F.col("path") != "p5000")).isEmpty()
    seeds = spark.createDataFrame([(0, "c", "p0"), (1, "d", "p4000")], schemas.CATEGORY_SEEDS)
    walked = pages.pagination_chain(edges, seeds)
    assert {r.seed_no: (r.n, r.last) for r in walked.groupBy("seed_no").agg(
        F.count("*").alias("n"), F.max_by("page_url", "hop").alias("last")).collect()} == {0: (5001, "p5000"), 1: (1001, "p5000")}


def test_a_limit_cuts_chains_and_says_so(spark):
    edges = spark.createDataFrame([(f"p{n}", f"p{n + 1}") for n in range(1, 25)] + [("q1", "q2")], "url string, next_url string")
    seeds = spark.createDataFrame([(0, "long", "p1"), (1, "short", "q1")], schemas.CATEGORY_SEEDS)
    walked = pages.pagination_chain(edges, seeds, 20)
    assert {r.category: r["count"] for r in walked.groupBy("category").count().collect()} == {"long": 20, "short": 2}
    assert [tuple(r) for r in pages.cut_chains(walked, edges, 20).collect()] == [(0, "long", "p21")]


def test_self_link_ends_the_chain(spark):
    outline = spark.createDataFrame([("p1", ["a"], "p1"), ("p2", ["b"], None)],
                                    "url string, links array<string>, next_url string")
    assert pages.page_edges(outline).count() == 0


def test_many_seeds_on_one_page(spark):
    """Thousands of categories that start on the same page each get their own chain."""
    edges = spark.createDataFrame([("p1", "p2"), ("p2", "p3")], "url string, next_url string")
    seeds = spark.range(3000).select(
        F.col("id").alias("seed_no"), F.concat(F.lit("c"), "id").alias("category"), F.lit("p1").alias("url"))
    assert pages.pagination_chain(edges, seeds).groupBy("hop").count().orderBy("hop").collect() == [
        (0, 3000), (1, 3000), (2, 3000)]


def test_the_last_capture_counts(spark):
    link = '<a class="woocommerce-LoopProduct-link" href="{}">x</a>'
    product = '<h1 class="product_title entry-title">{}</h1>'
    captured = spark.createDataFrame([
        ("https://s.com/c", listing([link.format("/p/old")], "/c/2"), 1), ("https://s.com/c", listing([link.format("/p/1")]), 2),
        ("https://s.com/c/2", listing([link.format("/p/2")]), 1),
        ("https://s.com/p/1", product.format("New"), 4), ("https://s.com/p/1", product.format("Old"), 3),
        ("https://s.com/p/1", None, 5), ("https://s.com/p/old", product.format("Gone"), 1),
    ], schemas.CAPTURED_PAGES)
    seeds = spark.createDataFrame([(0, "C", "https://s.com/c")], schemas.CATEGORY_SEEDS)
    assert [(r.product_url, r.title) for r in ingest.ingest_pages(captured, seeds).collect()] == [("https://s.com/p/1", "New")]


def test_ingest_pages(spark):
    link = '<a class="woocommerce-LoopProduct-link" href="{}">x</a>'
    product = '<h1 class="product_title entry-title">{}</h1><span class="sku">{}</span>'
    captured = [
        ("https://s.com/c1", listing([link.format("/p/1"), link.format("/p/2")], "/c1/2")),
        ("https://s.com/c1/2", listing([link.format("/p/1"), link.format("/p/gone")], "/c1/2")),
        ("https://s.com/c2", listing([link.format("/p/2")])),
        ("https://s.com/p/1", product.format("One", "S1")),
        ("https://s.com/p/2", product.format("T" * 256, "S2")),
        ("https://s.com/p/3", product.format("Not listed", "S3")),
    ]
    captured = spark.createDataFrame([(*page, n) for n, page in enumerate(captured)], schemas.CAPTURED_PAGES)
    seeds = spark.createDataFrame([(0, "C1", "https://s.com/c1"), (1, "C2", "https://s.com/c2")], schemas.CATEGORY_SEEDS)
    rows = ingest.ingest_pages(captured, seeds)
    assert rows.schema.simpleString() == schemas.SCRAPED_PRODUCTS.simpleString()
    # The third link has no page; a long title is no reason to leave a product out.
    assert sorted((r.product_url, r.title, r.price, r.tag, r.sku, r.category) for r in rows.collect()) == [
        ("https://s.com/p/1", "One", "N/A", "N/A", "S1", "C1"), ("https://s.com/p/2", "T" * 256, "N/A", "N/A", "S2", "C2")]
    contents = ingest.read_captures(captured)
    links = ingest.listed_links(contents, seeds)
    latest = {r.link: r.category for r in ingest.latest_category(links).collect()}
    assert latest == {"https://s.com/p/1": "C1", "https://s.com/p/2": "C2", "https://s.com/p/gone": "C1"}
    assert [r.link for r in pages.missing_pages(links, contents).collect()] == ["https://s.com/p/gone"]
