"""Feed pages and products on literal payloads."""

import json
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wareloom import schemas
from wareloom.functions import feed
from wareloom.operators import contract, sinks
from wareloom.plans import ingest
from wareloom.sources import feeds, testtables
from wareloom.streaming import ingest as stream

URL = "https://www.shop.com"


def payloads(spark, pages):
    rows = [(0, s, f"https://{s}.com", p, st, b, n) for n, (s, p, st, b) in enumerate(pages)]
    return spark.createDataFrame(rows, schemas.FEED_PAYLOADS)


def body(*products):
    return json.dumps({"products": list(products)})


def read(spark, *products):
    """Flattened rows of one page, in order; text products are raw JSON."""
    raw = ",".join(p if isinstance(p, str) else json.dumps(p) for p in products)
    page = spark.createDataFrame([(0, "shop", URL, 1, 200, f'{{"products":[{raw}]}}', 0)], schemas.FEED_PAYLOADS)
    return feeds.flatten_pages(page).orderBy("pos").collect()


OK = body({"title": "x", "handle": "x"})


def test_contiguous_pages(spark):
    pages = payloads(spark, [
        ("a", 1, 200, OK), ("a", 2, 200, OK), ("a", 3, 200, body()), ("a", 4, 200, OK),
        ("b", 1, 403, OK), ("b", 2, 200, OK),
        ("c", 1, 200, OK), ("c", 2, 200, "{oops"),
        ("d", 1, 200, OK), ("d", 3, 200, OK),
        ("e", 2, 200, OK),
        ("f", 1, 200, '{"products": {"k": 1}}'), ("f", 2, 200, '{"products": "abc"}'), ("f", 3, 200, "{}"),
        ("g", 1, 200, "[1]"), ("h", 1, None, None), ("i", 1, 200, '{"products": 7}'),
        ("j", 1, 200, '{"products": [null]}'), ("j", 2, 200, '{"products": null}'),
        ("k", 1, 200, '{"products": [{"title": "x", "title": "y"}]}'),
    ])
    kept = feeds.contiguous_pages(pages).select("store", "page").collect()
    assert sorted(map(tuple, kept)) == [
        ("a", 1), ("a", 2), ("c", 1), ("d", 1), ("f", 1), ("f", 2), ("j", 1), ("k", 1)]


def test_prices(spark):
    prices = ["12.5", 12.5, "", None, 0, "abc", "12d", " 7 ", "1_000", "1e2", "nan", "inf", "99999999.99", "1e8", True,
              [1], -3, "5.", ".5", "+4"]
    rows = read(spark, *[{"title": "t", "handle": "h", "variants": [{"price": p}]} for p in prices])
    good = [r.price if r.reject_reason is None else r.reject_reason for r in rows]
    assert good == [12.5, 12.5, 0.0, 0.0, 0.0, "bad price", "bad price", 7.0, 1000.0, 100.0, "bad price", "bad price",
                    99999999.99, "bad price", 1.0, "bad price", -3.0, 5.0, 0.5, 4.0]


def test_missing_keys_and_nulls(spark):
    empty, nulls, no_title, twice = read(
        spark, {}, {"title": "t", "vendor": None, "body_html": None, "product_type": None}, {"title": None},
        '{"title":"a","title":"b"}')
    assert (empty.title, empty.vendor, empty.category, empty.description) == ("N/A", "N/A", "N/A", "")
    assert (empty.price, empty.availability, empty.product_url) == (0.0, "Out of Stock", "N/A")
    assert (nulls.title, nulls.vendor, nulls.category, nulls.description) == ("t", None, None, None)
    assert no_title.reject_reason == "title is null"
    assert (twice.title, twice.reject_reason) == ("b", None)


def test_availability_follows_truth(spark):
    values = [True, False, None, 1, 0, "false", "", [], [0], {}, {"a": 1}, 0.0, 0.5]
    rows = read(spark, *[{"title": "t", "variants": [{"price": "1", "available": v}]} for v in values])
    assert [r.availability == "Available" for r in rows] == [bool(v) for v in values]


def test_variants(spark):
    values = [[], None, {}, "", 0, [{"price": "2"}, {"price": "3"}], [None], ["x"], {"a": 1}, "abc"]
    rows = read(spark, *[{"title": "t", "variants": v} for v in values])
    assert [r.price if r.reject_reason is None else None for r in rows] == [0.0] * 5 + [2.0] + [None] * 4


def test_handles_and_odd_products(spark):
    rows = read(spark, {"title": "t", "handle": 5}, {"title": "t", "handle": 0}, 5, None, "[]", {"title": {"a": 1}})
    assert [r.product_url for r in rows[:2]] == [f"{URL}/products/5", "N/A"]
    assert [r.reject_reason for r in rows[2:]] == ["product is not an object"] * 3 + ["text field is nested"]
    assert rows[0].store_name == "shop"


def test_last_write_wins_and_is_repeatable(spark):
    def item(handle, price):
        return {"title": "t", "handle": handle, "variants": [{"price": price}]}

    pages = payloads(spark, [
        ("a", 1, 200, body(item("h", "1"), item("", "2"), item("h", "3"))),
        ("a", 2, 200, body(item("i", "4"))),
        ("b", 1, 200, body(item("h", "5"), item(None, "6"), item("j", "bad"))),
    ])
    wanted = {("https://a.com/products/h", 3.0), ("https://a.com/products/i", 4.0), ("https://b.com/products/h", 5.0),
              ("N/A", 6.0)}
    once = ingest.ingest_feed(pages)
    assert {(r.product_url, float(r.price)) for r in once.collect()} == wanted
    assert once.schema.simpleString() == schemas.PRODUCTS.simpleString()
    assert {(r.product_url, float(r.price)) for r in ingest.ingest_feed(pages.repartition(7)).collect()} == wanted


def test_contract_breaks_are_rejected(spark):
    pages = payloads(spark, [("a", 1, 200, body({"title": "x" * 513, "handle": "h"}, {"title": None, "handle": "i"}))])
    flat = feeds.flatten_feed(pages)
    products = ingest.products_table(flat)
    assert [r.title for r in products.collect()] == ["x" * 513]
    assert [r.reject_reason for r in ingest.feed_rejects(flat).collect()] == ["title is null"]
    found = {(r.column_name, r.rule): r.violations for r in contract.contract_violations(products, schemas.PRODUCTS_CONTRACT).collect()}
    assert found["title", "length <= 512"] == 1


@pytest.mark.parametrize("files_per_batch", [1, 100])
def test_stream_gives_the_batch_result(spark, tmp_path, files_per_batch):
    def item(handle, price):
        return {"title": "t", "handle": handle, "variants": [{"price": price}]}

    pages = payloads(spark, [
        ("a", 3, 200, body(item("late", "9"))), ("a", 2, 500, "x"), ("a", 1, 200, body(item("h", "1"))),
        ("b", 2, 200, body(item("h", "2"))), ("b", 1, 200, body(item("h", "3"), item("i", "4"), item("k", "x"))),
    ])
    landing, table, progress = (str(tmp_path / name) for name in ("landing", "table", "progress"))
    for row in pages.collect():
        spark.createDataFrame([row], schemas.FEED_PAYLOADS).coalesce(1).write.mode("append").parquet(landing)
    for _ in range(2):
        stream.run_stream(spark, landing, table, progress, files_per_batch)
    got = stream.read_stream_table(spark, table, progress)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ingest.ingest_feed(pages).collect()))
    more = spark.createDataFrame([(0, "b", "https://b.com", 3, 200, body(item("i", "8")), 99)], schemas.FEED_PAYLOADS)
    more.write.mode("append").parquet(landing)
    stream.compact_stream(spark, table, progress, table + "2")
    stream.run_stream(spark, landing, table + "2", progress, files_per_batch)
    prices = {r.product_url: float(r.price) for r in stream.read_stream_table(spark, table + "2", progress).collect()}
    assert prices["https://b.com/products/i"] == 8.0
    assert [(r.store, r.page, r.reject_reason) for r in stream.read_stream_rejects(spark, table + "2", progress).collect()] == [
        ("b", 1, "bad price")]
    counts = sinks.read_batches(spark, f"{table}2-counts", StructType.fromDDL("store string, page long, accepted long, rejected long"))
    assert sorted(tuple(r)[:4] for r in counts.collect()) == [("a", 1, 1, 0), ("b", 1, 2, 1), ("b", 2, 1, 0), ("b", 3, 1, 0)]


def test_state_follows_late_and_repeated_fetches(spark, tmp_path):
    """Batch after batch, the state holds what the verdicts of all batches come to."""
    progress = str(tmp_path / "progress")
    batches = [
        [(1, 10, False), (2, 20, False), (300, 1, False)],
        [(n, n, False) for n in range(3, 300)],
        [(150, 149, True)],
        [(150, 151, True), (301, 5, False)],
        [(150, 152, False), (302, 6, True)],
        [(302, 7, False), (1, 11, True)],
        [(1, 12, False)],
    ]
    stops, seen = [], []
    for batch in batches:
        rows = spark.createDataFrame([(0, store, *fetch) for fetch in batch for store in "ab"], stream.VERDICTS)
        rows.coalesce(1).write.mode("append").parquet(f"{progress}-verdicts")
        stream.stream_stops(spark, progress).awaitTermination()
        seen += batch
        pages = stream.counting_pages(spark, progress).collect()
        stops.append(max([r.page for r in pages if r.store == "a"], default=0) + 1)
        verdicts = spark.createDataFrame(
            [(0, store, page, seq, "bad" if bad else feeds.PAGE_OK) for page, seq, bad in seen for store in "ab"],
            "crawl long, store string, page long, fetch_seq long, verdict string")
        assert sorted(map(tuple, pages)) == sorted(map(tuple, feeds.counting_pages(verdicts).collect()))
    assert stops == [3, 301, 301, 150, 302, 1, 303]


def test_stream_reads_shuffle_no_products_to_their_pages(spark, tmp_path):
    """Replaced fetches are left out, and so are those that the state has not taken in yet."""
    landing, table, progress = (str(tmp_path / name) for name in ("landing", "table", "progress"))
    first = crawls(spark, (0, 1, 500, "1"), (0, 1, 200, "x"), (0, 2, 200, "y"), (0, 2, 200, "3"), (0, 4, 200, "z"))
    first.write.parquet(landing)
    stream.run_stream(spark, landing, table, progress)
    rejects, products = (read(spark, table, progress) for read in (stream.read_stream_rejects, stream.read_stream_table))
    assert "Exchange hashpartitioning" not in rejects._jdf.queryExecution().executedPlan().toString()
    assert products._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert [(r.page, r.reject_reason) for r in rejects.collect()] == [(1, "bad price")]
    crawls(spark, (0, 7, 200, "1")).withColumns({"page": F.lit(2).cast("long"), "fetch_seq": F.lit(9).cast("long")}).write.mode(
        "append").parquet(landing)
    stream.stream_feed(spark, landing, table, progress).awaitTermination()
    for moved in (table, table + "2"):
        got = [float(r.price) for r in stream.read_stream_table(spark, moved, progress).collect()]
        assert got == [3.0]
        if moved == table:
            stream.compact_stream(spark, table, progress, table + "2")


def test_compaction_shuffles_no_products(spark, tmp_path, monkeypatch):
    """Replaced fetches go; pages beyond a gap stay."""
    landing, table, progress = (str(tmp_path / name) for name in ("landing", "table", "progress"))
    crawls(spark, (0, 1, 200, "1"), (0, 1, 200, "2"), (0, 2, 500, "3"), (0, 3, 200, "x"), (0, 0, 200, "4")).write.parquet(landing)
    stream.run_stream(spark, landing, table, progress)
    plans, append = [], sinks.append_batch
    monkeypatch.setattr(sinks, "append_batch", lambda df, *to: (
        plans.append(df._jdf.queryExecution().executedPlan().toString()), append(df, *to)))
    stream.compact_stream(spark, table, progress, table + "2")
    assert "Exchange hashpartitioning" not in plans[0]
    kept = sinks.read_batches(spark, table + "2", stream.FEED_LOG).collect()
    assert sorted((r.page, r.fetch_seq, r.pos) for r in kept) == [(1, 1, 0), (2, 2, None), (3, 3, 0)]


def test_bodies_are_parsed_once(spark):
    pages = payloads(spark, [("a", 1, 200, OK)])
    plan = feeds.accepted(feeds.read_pages(pages))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"parseJson\(body", plan)) == 1, plan


def test_stops_do_not_depend_on_one_task(spark):
    """Pages come to bitmaps by one aggregate; no window gathers a store and no join looks predecessors up."""
    verdicts = feeds.page_verdicts(payloads(spark, [("a", 1, 200, OK)]))
    plan = feeds.store_stops(feeds.last_fetches(verdicts))._jdf.queryExecution().toString()
    assert "Window" not in plan and "Join" not in plan and "bitmap_construct_agg" in plan


@pytest.mark.parametrize("missing, bad, stop", [
    ((), (), 70_001), ((1,), (), 1), ((32_768,), (), 32_768), ((32_769,), (), 32_769), ((70_000, 40_001), (), 40_001),
    ((), (8, 9), 8), (range(1, 32_769), (), 1), (range(32_769, 65_537), (), 32_769), ((17,), (16,), 16),
])
def test_first_gap_in_bitmaps(spark, missing, bad, stop):
    numbers = [n for n in (list(missing) if len(missing) < 9 else [])]
    pages = spark.range(-1, 70_001).where(~F.col("id").isin(numbers)).select(
        F.lit(0).alias("crawl"), F.lit("s").alias("store"), F.col("id").alias("page"), F.col("id").isin(list(bad)).alias("bad"))
    if len(missing) > 9:
        pages = pages.where(~F.col("page").between(missing[0], missing[-1]))
    assert [r.stop_page for r in feeds.store_stops(pages).collect()] == [stop]


def test_long_store_with_one_gap(spark):
    pages = spark.range(1, 5001).where("id != 4000").select(
        F.lit(0).alias("crawl"), F.lit("big").alias("store"), F.col("id").alias("page"), F.col("id").alias("fetch_seq"),
        F.lit(feeds.PAGE_OK).alias("verdict"))
    assert feeds.store_stops(feeds.last_fetches(pages)).collect()[0].stop_page == 4000


def crawls(spark, *fetches):
    """``(crawl, page, status, price)`` of one store, in the order they were fetched."""
    rows = [(crawl, "a", "https://a.com", page, status,
             body({"title": "t", "handle": str(page), "variants": [{"price": price}]}), n)
            for n, (crawl, page, status, price) in enumerate(fetches)]
    return spark.createDataFrame(rows, schemas.FEED_PAYLOADS)


@pytest.mark.parametrize("fetches, wanted", [
    ([(0, 1, 200, "1")], {"1": 1.0}),
    ([(0, 1, 200, "1"), (1, 1, 429, "2")], {"1": 1.0}),
    ([(0, 1, 200, "1"), (1, 1, 429, "2"), (2, 1, 200, "3")], {"1": 3.0}),
    ([(0, 1, 200, "1"), (0, 2, 200, "2"), (1, 1, 200, "3"), (1, 2, 500, "4")], {"1": 3.0, "2": 2.0}),
    ([(0, 1, 429, "1"), (0, 1, 200, "2"), (0, 2, 200, "3")], {"1": 2.0, "2": 3.0}),
    ([(0, 1, 200, "1"), (0, 1, 429, "2")], {}),
    ([(None, 1, 200, "1"), (None, 2, 200, "2")], {"1": 1.0, "2": 2.0}),
])
def test_crawls_stop_on_their_own(spark, tmp_path, fetches, wanted):
    fetched = crawls(spark, *fetches)
    prices = {r.product_url[-1]: float(r.price) for r in ingest.ingest_feed(fetched).collect()}
    assert prices == wanted
    landing, table, progress = (str(tmp_path / name) for name in ("landing", "table", "progress"))
    for row in fetched.collect():
        spark.createDataFrame([row], schemas.FEED_PAYLOADS).coalesce(1).write.mode("append").parquet(landing)
    stream.run_stream(spark, landing, table, progress)
    assert {r.product_url[-1]: float(r.price) for r in stream.read_stream_table(spark, table, progress).collect()} == wanted


def test_a_body_larger_than_a_variant(spark):
    first = F.concat(F.lit('{"title":"big","vendor":null,"body_html":"'), F.repeat(F.lit("x"), 100_000),
                     F.lit('","handle":"h","variants":[{"price":"5"}]},'))
    text = F.concat(F.lit('{"products":['), F.repeat(first, 1400), F.lit('7,{"title":"small","handle":"i"}]}'))
    pages = spark.range(1).select(
        F.lit(0).cast("long").alias("crawl"), F.lit("a").alias("store"), F.lit("https://a.com").alias("base_url"),
        F.lit(1).cast("long").alias("page"), F.lit(200).alias("status"), text.alias("body"), F.lit(1).cast("long").alias("fetch_seq"))
    rows = feeds.flatten_pages(pages).select(
        "title", "vendor", F.length("description").alias("n"), "price", "reject_reason").collect()
    assert [tuple(r) for r in rows[:1400]] == [("big", None, 100_000, 5.0, None)] * 1400
    assert [(r.title, r.vendor, r.reject_reason) for r in rows[1400:]] == [
        ("N/A", "N/A", "product is not an object"), ("small", "N/A", None)]
    assert [r.verdict for r in feeds.page_verdicts(pages).collect()] == [feeds.PAGE_OK]


@pytest.mark.parametrize("text", [
    '{"products":[]}', '{"products":[{"a":1},{"b":[1,{"c":"],}"}]}, 7 , null,"x"] , "k":[1]}', ' {"k":{}, "products" :\n[1]} ',
    '{"products":[1],"products":[2,3]}', '{"products":[1],"products":7}', "{}", "[1]", '{"products":[1', '{"products":[1,]}',
    '{"products":[1]} x', '{"products":{"a":[1]}}', '{"products":["\\"]","\\\\"]}', "", '{"products":[12345678901234567890.123,1.50]}', '{"products" 1}',
])
def test_products_keep_their_own_text(text):
    try:
        page = json.loads(text)
        wanted = page.get("products") if isinstance(page, dict) else None
    except ValueError:
        wanted = None
    got = feed.split_products(text)
    assert (got if got is None else [json.loads(p) for p in got]) == (wanted if isinstance(wanted, list) else None)
    assert got is None or all(p in text for p in got)


def test_size_of_a_body_changes_no_value(spark, monkeypatch):
    """The same products read as parts of a large body and as a VARIANT."""
    items = ['{"title":12345678901234567890.123,"handle":1.50,"variants":[{"price":"5"}]}', '{"title":"x","vendor":null,"handle":"h"}',
             '{"title":[1],"handle":"i"}', "7", '{"title":true,"body_html":"\\u00e9 \\"q\\"","handle":1e2,"variants":[{"price":1.10}]}']
    pages = payloads(spark, [("a", 1, 200, '{"products":[' + ",".join(items) + "]}"), ("b", 1, 200, '{"products":[]}')])
    small = feeds.flatten_feed(pages).collect()
    monkeypatch.setattr(feeds, "LARGE_BODY", 1)
    parse = feeds._parse
    monkeypatch.setattr(feeds, "_parse", lambda p: parse(p).withColumn("document", F.when(F.col("parts").isNull(), F.col("document"))))
    assert sorted(map(str, feeds.flatten_feed(pages).collect())) == sorted(map(str, small)) and len(small) == 5


def test_order_holds_for_any_sequence_number(spark):
    pairs = [(0, 5), (1, 0), ((1 << 39) - 1, 7), (1 << 39, 0), ((1 << 62) + 1, 0), ((1 << 62) + 1, 1 << 30)]
    rows = spark.createDataFrame([(n, *pair) for n, pair in enumerate(pairs)], "n int, s long, p int")
    assert [r.n for r in rows.orderBy(feeds.ordinal(F.col("s"), F.col("p"))).collect()] == list(range(len(pairs)))


def test_stores_without_a_good_page_are_listed(spark):
    from wareloom.sources import seeds
    stores = seeds.store_seeds(spark, ["https://a.com", "https://b.com", "https://c.com"])
    verdicts = feeds.page_verdicts(payloads(spark, [("a", 1, 200, OK), ("b", 1, 500, OK)]))
    assert sorted(r.store for r in feeds.silent_stores(verdicts, stores).collect()) == ["b", "c"]


def test_pages_are_joined_before_their_products_are_spread_out(spark):
    plan = feeds.flatten_feed(payloads(spark, [("a", 1, 200, OK), ("a", 2, 500, OK)]))._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.index("Generate posexplode") < plan.index("LeftSemi")


def test_plain_texts_are_never_taken_from_another_place(spark):
    """Bodies of which a plain reading does not fit as a whole, or gives another text than the product holds."""
    odd = [
        '{"products": [{"title": "old", "handle": "o"}], "products": [{"title": "new", "handle": "n"}, 7]}',
        '{"products": [{"title": "a", "handle": "x", "variants": "text"}, 7, {"title": "b", "handle": "y"}]}',
        '{"products": [{"title": 5, "handle": 1.50, "variants": [{"price": 2.50}]}, {"title": "caf\\u00e9 \\ud800 \\"q\\"", "handle": "z"}]}',
        '{"products": [{"title": [1], "title": "last", "handle": "x", "handle": null, "variants": [{"price": " 7 "}, 3]}]}',
        '{"products": [{"title": "t", "title": true, "handle": "", "variants": [{"price": "1"}], "variants": []}], "misfit": "x"}',
    ]
    pages = payloads(spark, [("a", n + 1, 200, b) for n, b in enumerate(odd)])
    names = ["page", "pos", "product_url", "title", "price", "reject_reason"]
    rows = feeds.flatten_feed(pages).select(*names).orderBy("page", "pos").collect()
    url = "https://a.com/products/"
    assert [tuple(r) for r in rows] == [
        (1, 0, f"{url}n", "new", 0.0, None), (1, 1, "N/A", "N/A", 0.0, "product is not an object"),
        (2, 0, f"{url}x", "a", 0.0, "first variant is not an object"), (2, 1, "N/A", "N/A", 0.0, "product is not an object"),
        (2, 2, f"{url}y", "b", 0.0, None),
        (3, 0, f"{url}1.5", "5", 2.5, None), (3, 1, f"{url}z", 'café ? "q"', 0.0, None),
        (4, 0, "N/A", "last", 7.0, None),
        (5, 0, "N/A", "true", 0.0, None),
    ]


def test_a_batch_looks_at_its_own_folder_only(spark, tmp_path, monkeypatch):
    path, rows, seen = str(tmp_path / "log"), spark.range(2).selectExpr("id"), []
    for batch in (0, 1, 2):
        sinks.append_batch(rows, path, batch)
    look = sinks._batch_attempts
    monkeypatch.setattr(sinks, "_batch_attempts", lambda s, p, batch: seen.append(batch) or look(s, p, batch))
    sinks.append_batch(rows.where("id = 1"), path, 1)
    assert [tuple(r) for r in sinks.read_batch(spark, path, rows.schema, 1).collect()] == [(1, 1)]
    assert set(seen) == {1} and sinks.read_batch(spark, path, rows.schema, 9).count() == 0
    assert sinks.read_batches(spark, path, rows.schema).count() == 5


def test_feed_products_are_made_before_they_are_gathered(spark, tmp_path):
    lines = ("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate timestamp, l_returnflag string, "
             "l_linestatus string, l_extendedprice double, l_quantity double")
    rows = [(7, n, 1, 2, None, "N", "O", 5.0, 20.0) for n in (3, 1, 2)]
    spark.createDataFrame(rows, lines).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, "p", "Brand#4", "T")], "p_partkey long, p_name string, p_brand string, p_type string").write.parquet(
        str(tmp_path / "part.parquet"))
    made = testtables.feed_payloads(spark, str(tmp_path))
    assert "collect_list(item" in made._jdf.queryExecution().optimizedPlan().toString()
    page = made.collect()
    prices = [p["variants"][0]["price"] for p in json.loads(page[0].body)["products"]]
    assert len(page) == 1 and prices == [" 5.00", "5.00", "5.00"]
