"""Landed product feeds: which pages count, and one row per product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wareloom.functions import feed, urls
from wareloom.schemas import ORDINAL
from wareloom.session import configure, stage

FIRST_HTTP_ERROR = 400
PAGE_OK = "ok"
#: Positions in a page or a chain are ints.
POSITIONS = 1 << 31
#: Bodies from this size on may be more than a VARIANT holds.
LARGE_BODY = 1 << 24
#: Pages to a bitmap, as Spark's functions on bitmaps have it.
BITMAP_PAGES = 1 << 15
FETCH = ["crawl", "store", "page", "fetch_seq"]
PRODUCT_COLUMNS = ["product_url", "title", "vendor", "price", "availability", "description", "category"]


def ordinal(sequence: Column, position: Column) -> Column:
    """One sortable number from a sequence number and a position: any long, any int."""
    return (sequence.cast(ORDINAL) * F.lit(POSITIONS) + position).cast(ORDINAL)


def _identified(payloads: DataFrame) -> DataFrame:
    """Fetches landed without a crawl or a sequence number count as the first."""
    return payloads.withColumns({
        "crawl": F.coalesce("crawl", F.lit(0).cast("long")), "fetch_seq": F.coalesce("fetch_seq", F.lit(0).cast("long"))})


def _parse(payloads: DataFrame) -> DataFrame:
    """Adds ``document``, and ``parts`` of bodies that may be more than a VARIANT holds: the text of each product."""
    configure(payloads.sparkSession)
    answered = F.col("status") < FIRST_HTTP_ERROR
    read = _identified(payloads).withColumn("document", F.when(answered, F.try_parse_json("body")))
    large = answered & (F.octet_length("body") >= LARGE_BODY)
    return read.withColumn("parts", feed.large_products(F.col("body"), large))


def _verdict() -> Column:
    document, products = F.col("document"), feed.field(F.col("document"), "$.products")
    products_kind = feed.kind(products)
    return (
        F.when(F.col("status").isNull(), "no response")
        .when(F.col("status") >= FIRST_HTTP_ERROR, "http error")
        .when(document.isNull() & (F.size("parts") > 0), PAGE_OK)
        .when(document.isNull() & F.col("parts").isNotNull(), "no products")
        .when(document.isNull(), "undecodable body")
        # Nearly all pages end here, before anything has to look at the whole list.
        .when(feed.field(document, "$.products[0]").isNotNull(), PAGE_OK)
        .when(products.isNull() & (feed.kind(document) != feed.OBJECT), "body is not an object")
        .when(~feed.truthy(products, products_kind, feed.as_text(products)), "no products")
        # Text or an object has members, though none of them is a product.
        .when(products_kind.isin(feed.OBJECT, feed.STRING), PAGE_OK)
        .otherwise("products is not a list")
    )


def page_verdicts(payloads: DataFrame) -> DataFrame:
    """``crawl, store, page, fetch_seq, verdict``: the narrow log that decides where stores stop."""
    return _parse(payloads).select(*FETCH, _verdict().alias("verdict"))


def last_fetches(verdicts: DataFrame) -> DataFrame:
    """``crawl, store, page, fetch_seq, bad``: a page fetched again within a crawl counts by its last fetch."""
    return last_judged(verdicts.withColumn("bad", F.col("verdict") != PAGE_OK))


def last_judged(fetches: DataFrame) -> DataFrame:
    """``last_fetches`` of fetches that have ``bad`` in place of a verdict."""
    return fetches.groupBy("crawl", "store", "page").agg(
        F.max("fetch_seq").alias("fetch_seq"), F.max_by("bad", "fetch_seq").alias("bad"))


def _first_unset(bitmap: Column) -> Column:
    """Position of the first bit of a bitmap that is not set; its length in bits where all are."""
    digits = F.hex(bitmap)
    full = (F.length(F.regexp_extract(digits, "^(?:FF)*+", 0)) / 2).cast("int")
    # Adding one carries up to the lowest bit that is not set.
    byte = F.conv(F.substr(digits, 2 * full + 1, F.lit(2)), 16, 10).cast("int")
    carried = F.bitwise_not(byte).bitwiseAND(byte + 1)
    return full * 8 + F.when(byte.isNull(), 0).otherwise(F.bit_count(carried - 1))


def page_bitmaps(pages: DataFrame) -> DataFrame:
    """``crawl, store, bucket, bitmap``: the good pages of each crawl of a store, a bit per page.

    Bitmaps of several runs merge by ``bitmap_or_agg``.
    """
    good = pages.where(~F.col("bad") & (F.col("page") >= 1))
    return good.groupBy("crawl", "store", F.bitmap_bucket_number("page").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("page")).alias("bitmap"))


def store_stops(pages: DataFrame) -> DataFrame:
    """``crawl, store, stop_page``: the first page from 1 on that is bad or not there, from the last fetches.

    One task works on a bitmap, not on a store, and a store comes to one
    number per bitmap, so neither a huge store nor many small ones gather
    their pages anywhere. What one crawl stops at says nothing about another.
    Stores without a good page have no row.
    """
    unset = page_bitmaps(pages).select("crawl", "store", "bucket", _first_unset(F.col("bitmap")).alias("unset"))
    buckets = unset.groupBy("crawl", "store").agg(F.array_sort(F.collect_list(F.struct("bucket", "unset"))).alias("buckets"))
    # Where a bitmap that should come next is not there, its first page is missing.
    ends = F.transform("buckets", lambda b, n: F.when(b["bucket"] != n + 1, 0).when(b["unset"] < BITMAP_PAGES, b["unset"]))
    numbered = F.transform(ends, lambda end, n: n.cast("long") * BITMAP_PAGES + end + 1)
    after_all = F.size("buckets").cast("long") * BITMAP_PAGES + 1
    return buckets.select("crawl", "store", F.coalesce(F.array_min(numbered), after_all).alias("stop_page"))


def before_stops(rows: DataFrame, stops: DataFrame) -> DataFrame:
    """Rows of the pages before the stop of their crawl of a store."""
    before_stop = F.col("page").between(1, F.col("stop_page") - 1)
    return rows.join(stops, ["crawl", "store"]).where(before_stop).select(*rows.columns)


def counting_pages(verdicts: DataFrame) -> DataFrame:
    """``crawl, store, page, fetch_seq`` of the fetches that count."""
    pages = stage(last_fetches(verdicts))
    return before_stops(pages, store_stops(pages)).select(*FETCH)


def keep_contiguous(rows: DataFrame, counting: DataFrame) -> DataFrame:
    """Rows of the fetches that count.

    The join carries no hint: the size of ``counting`` decides between
    broadcast and a shuffle, which goes by page, so no store is too large.
    """
    return rows.join(counting, FETCH, "left_semi")


def contiguous_pages(payloads: DataFrame) -> DataFrame:
    """Landed pages up to the first error, undecodable or empty page or gap of their crawl.

    The counting pages, one narrow row each, are written out first. Their size
    is then known when the join is planned, so page bodies are shuffled only
    if there are too many pages to broadcast.
    """
    return keep_contiguous(_identified(payloads), stage(counting_pages(page_verdicts(payloads))))


def judged_pages(payloads: DataFrame) -> DataFrame:
    """One row per landed page: ``verdict``, ``base_url`` and what its products are read from.

    That is ``body`` with ``document``, or ``parts``. What a page without a
    product list holds is not kept.
    """
    kept = F.when(F.col("verdict") == PAGE_OK, F.struct(
        F.when(F.col("document").isNotNull(), F.col("body")).alias("body"), "document", "parts"))
    return _parse(payloads).withColumn("verdict", _verdict()).select(
        *FETCH, "base_url", "verdict", *[kept[name].alias(name) for name in ("body", "document", "parts")])


def landed_pages(payloads: DataFrame) -> DataFrame:
    """``judged_pages`` written out, for the verdicts alone and for the products of the pages that count."""
    return stage(judged_pages(payloads).drop("document"))


def page_products(pages: DataFrame) -> DataFrame:
    """One row per product of each of ``judged_pages``, with ``verdict`` and ``reject_reason``.

    A page without a product list gives one row, its ``pos`` NULL.
    ``ordinal`` orders products by fetch, then by position in the page.
    """
    if "document" not in pages.columns:
        configure(pages.sparkSession)
        pages = pages.withColumn("document", F.try_parse_json("body"))
    # The verdict comes before the products are spread out, or every product
    # would carry its whole page along and judge it again. The list of products
    # is a column first, as the generator would read the texts twice.
    listed = pages.withColumn("products", feed.product_list(F.col("document"), F.col("parts"), F.col("body")))
    rows = listed.select(*FETCH, "base_url", "verdict", F.posexplode_outer("products").alias("pos", "product"))
    rows = (
        rows.withColumns(feed.raw_columns(F.col("product")))
        .withColumns(feed.kind_columns())
        .withColumns(feed.value_columns(F.col("base_url")))
        .withColumns(feed.price_column())
    )
    finished = F.struct(
        *FETCH, "verdict", "pos", *PRODUCT_COLUMNS,
        urls.store_name(F.col("base_url")).alias("store_name"),
        ordinal(F.col("fetch_seq"), F.col("pos")).alias("ordinal"),
        feed.reject_reason().alias("reject_reason"),
    )
    # Going through a one-element array keeps filters on these columns from
    # being moved below, where they would work out every value again.
    return rows.select(F.inline(F.array(finished)))


def read_pages(payloads: DataFrame) -> DataFrame:
    """One row per product of each landed page, as ``page_products`` gives them, from one pass over the bodies."""
    return page_products(judged_pages(payloads))


def products_only(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("pos").isNotNull()).drop("verdict")


def flatten_pages(payloads: DataFrame) -> DataFrame:
    """Products of all readable pages, accepted and rejected together."""
    return products_only(read_pages(payloads))


def contiguous_products(pages: DataFrame) -> DataFrame:
    """Products of the contiguous pages, from ``landed_pages``.

    Pages are joined before their products are spread out, so neither pages
    that do not count nor single products go through the join.
    """
    counting = stage(counting_pages(pages.select(*FETCH, "verdict")))
    kept = keep_contiguous(pages.where(F.col("verdict") == PAGE_OK), counting)
    return products_only(page_products(kept))


def flatten_feed(payloads: DataFrame) -> DataFrame:
    """Products of the contiguous pages, accepted and rejected together.

    The payloads are gone through once, for the verdicts; only the bodies of
    pages that count are read for their products.
    """
    return contiguous_products(landed_pages(payloads))


def silent_stores(verdicts: DataFrame, stores: DataFrame) -> DataFrame:
    """``seed_no, base_url, store`` of the stores on the list that landed no good page in any crawl."""
    answered = verdicts.where(F.col("verdict") == PAGE_OK).select("store").distinct()
    return stores.join(answered, "store", "left_anti").select("seed_no", "base_url", "store")


def accepted(flat: DataFrame) -> DataFrame:
    return flat.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(flat: DataFrame) -> DataFrame:
    return flat.where(F.col("reject_reason").isNotNull()).select("crawl", "store", "page", "pos", "reject_reason")
