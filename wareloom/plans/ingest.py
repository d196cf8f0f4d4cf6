"""The two ingest runs: product feeds and captured pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wareloom import schemas
from wareloom.operators import contract, counters, keyed, sinks
from wareloom.session import stage
from wareloom.sources import feeds, pages as page_source


def judge(flat: DataFrame) -> DataFrame:
    """Let the table contract reject what the feed rules accepted."""
    broken = contract.broken_rule(schemas.PRODUCTS_CONTRACT, flat.columns)
    return flat.withColumn("reject_reason", F.coalesce("reject_reason", broken))


def products_table(flat: DataFrame) -> DataFrame:
    """Accepted products that fit the table, in its columns and types."""
    return contract.conform(feeds.accepted(judge(flat)), schemas.PRODUCTS)


def feed_rejects(flat: DataFrame) -> DataFrame:
    """Products left out, by the feed rules or by the table contract."""
    return feeds.rejected(judge(flat))


def feed_counts(flat: DataFrame) -> DataFrame:
    """Accepted and rejected products of each page."""
    return counters.outcome_counts(judge(flat), "crawl", "store", "page")


def ingest_feed(payloads: DataFrame) -> DataFrame:
    """Landed feed pages to the product table: the last write of each URL.

    Products without a handle share one URL, so the latest of them stays.
    """
    return keyed.keep_last(products_table(feeds.flatten_feed(payloads)))


def run_feed(payloads: DataFrame, table: str, batch: int, stores: DataFrame | None = None) -> None:
    """One batch of the product table, its rejects and its counts, from one pass over the payloads.

    They go to ``table``, ``table-rejects`` and ``table-counts``; the stores on
    the list ``stores`` that gave no good page go to ``table-silent``.
    """
    pages = feeds.landed_pages(payloads)
    flat = stage(judge(feeds.contiguous_products(pages)))
    sinks.append_batch(feed_rejects(flat), f"{table}-rejects", batch)
    sinks.append_batch(feed_counts(flat), f"{table}-counts", batch)
    if stores is not None:
        sinks.append_batch(feeds.silent_stores(pages, stores), f"{table}-silent", batch)
    sinks.append_batch(stamped(keyed.keep_last(products_table(flat))), table, batch)


def read_products(spark: SparkSession, table: str) -> DataFrame:
    """The product table after all batches, with the time ``scraped_at`` of each row's last write."""
    return sinks.read_keyed(spark, table, schemas.stored(schemas.PRODUCTS))


def read_scraped(spark: SparkSession, table: str) -> DataFrame:
    """The scraped product table after all batches, with ``scraped_at``."""
    return sinks.read_keyed(spark, table, schemas.stored(schemas.SCRAPED_PRODUCTS))


def stamped(rows: DataFrame, column: str = "scraped_at") -> DataFrame:
    """``rows`` with the time of the write."""
    return rows.withColumn(column, F.current_timestamp())


def latest_category(links: DataFrame) -> DataFrame:
    """One row per link: the category walked last keeps a product listed twice."""
    return keyed.keep_last(links, "link", ["seed_no", "ordinal"])


def read_captures(pages: DataFrame) -> DataFrame:
    """What the last capture of each page holds; staged, as links and fields are both read from it."""
    return stage(page_source.latest_captures(page_source.page_contents(pages)))


def listed_links(contents: DataFrame, seeds: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Distinct links of each category."""
    outline = page_source.listing_outline(contents)
    return page_source.category_links(outline, page_source.pagination_chain(page_source.page_edges(outline), seeds, max_pages))


def judged_pages(contents: DataFrame, links: DataFrame) -> DataFrame:
    """One row per listed and captured product, with ``reject_reason``."""
    last = latest_category(links)
    fields = page_source.product_fields(contents)
    rows = last.join(fields, last["link"] == fields["url"]).select(
        F.col("link").alias("product_url"), "title", "price", "tag", "sku", "category",
        # By seed, then by place in the walk: the place is below 2 ** 62.
        (F.col("seed_no").cast(schemas.ORDINAL) * F.lit(1 << 62) + F.col("ordinal")).cast(schemas.ORDINAL).alias("ordinal"),
    )
    return rows.withColumn("reject_reason", contract.broken_rule(schemas.SCRAPED_CONTRACT, rows.columns))


def page_rejects(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("reject_reason").isNotNull()).select("product_url", "category", "reject_reason")


def scraped_table(judged: DataFrame) -> DataFrame:
    return contract.conform(judged.where(F.col("reject_reason").isNull()), schemas.SCRAPED_PRODUCTS)


def ingest_pages(pages: DataFrame, seeds: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Captured pages to the scraped product table, one row per product URL.

    Each page is parsed once, for links and fields. A link whose page was not
    captured gives no row.
    """
    contents = read_captures(pages)
    return scraped_table(judged_pages(contents, listed_links(contents, seeds, max_pages)))


def run_pages(pages: DataFrame, seeds: DataFrame, table: str, batch: int, max_pages: int | None = None) -> None:
    """One batch of the scraped table, its rejects, missing pages, cut listings and counts.

    They go to ``table``, ``table-rejects``, ``table-missing``, ``table-cut`` and ``table-counts``.
    """
    contents = read_captures(pages)
    outline = page_source.listing_outline(contents)
    edges = page_source.page_edges(outline)
    chain = stage(page_source.pagination_chain(edges, seeds, max_pages))
    links = stage(page_source.category_links(outline, chain))
    judged = stage(judged_pages(contents, links))
    if max_pages is not None:
        sinks.append_batch(page_source.cut_chains(chain, edges, max_pages), f"{table}-cut", batch)
    sinks.append_batch(page_rejects(judged), f"{table}-rejects", batch)
    sinks.append_batch(page_source.missing_pages(links, contents).select("category", "link"), f"{table}-missing", batch)
    sinks.append_batch(counters.frontier_counts(links, contents), f"{table}-counts", batch)
    sinks.append_batch(stamped(scraped_table(judged)), table, batch)
