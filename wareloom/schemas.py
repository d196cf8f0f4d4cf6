"""Declared table shapes, fixed values and column contracts.

Nothing in the engine infers a schema: every stage takes and returns frames
whose columns are listed here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: results must carry these exact strings and numbers. -----
NOT_AVAILABLE = "N/A"
PARSE_ERROR = "N/A (Parse Error)"
UNKNOWN = "Unknown"
AVAILABLE = "Available"
OUT_OF_STOCK = "Out of Stock"

STRUCTURED_PLATFORM = "Shopify"
SCRAPED_PLATFORM = "WooCommerce"
SCRAPED_STORE = "Barefoot Buttons"

TOP_K = 20
FLAGSHIP_PER_STORE = 3
WEIGHT_AVAILABILITY = 0.6
WEIGHT_PRICE = 0.4
# ---------------------------------------------------------------------------

# Sequence numbers and positions side by side, wide enough for any two longs.
ORDINAL = T.DecimalType(38, 0)

STRUCTURED_PRIORITY = 0
SCRAPED_PRIORITY = 1

# ``fetch_seq`` and ``capture_seq`` grow with time, over all crawls.
FEED_PAYLOADS = T.StructType([
    T.StructField("crawl", T.LongType()),
    T.StructField("store", T.StringType()),
    T.StructField("base_url", T.StringType()),
    T.StructField("page", T.LongType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("body", T.StringType()),
    T.StructField("fetch_seq", T.LongType()),
])

CAPTURED_PAGES = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
    T.StructField("capture_seq", T.LongType()),
])

CATEGORY_SEEDS = T.StructType([
    T.StructField("seed_no", T.LongType()),
    T.StructField("category", T.StringType()),
    T.StructField("url", T.StringType()),
])

# Structured catalogue, as produced by the feed ingest.
PRODUCTS = T.StructType([
    T.StructField("product_url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("vendor", T.StringType()),
    T.StructField("price", T.DecimalType(10, 2)),
    T.StructField("availability", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("store_name", T.StringType()),
    T.StructField("ordinal", ORDINAL),
])

# Scraped catalogue, as produced by the page ingest; price is still text.
SCRAPED_PRODUCTS = T.StructType([
    T.StructField("product_url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("tag", T.StringType()),
    T.StructField("sku", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("ordinal", ORDINAL),
])

# The aligned frame: eleven catalogue columns in their published order, then
# the two columns that make "first" explicit.
CATALOGUE = T.StructType([
    T.StructField("product_url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("vendor", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("availability", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("product_category", T.StringType()),
    T.StructField("source_store_name", T.StringType()),
    T.StructField("source_platform", T.StringType()),
    T.StructField("product_tags", T.StringType()),
    T.StructField("sku", T.StringType()),
])
CATALOGUE_COLUMNS = CATALOGUE.names
ORDER_COLUMNS = ["source_priority", "ordinal"]

SCORE_INPUTS = ["price", "is_available_numeric"]
FILL_COLUMNS = ["title", "vendor", "product_category", "source_store_name", "product_tags", "sku"]

# Result tables, with the columns and narrow types they are stored in: fixed values.
SCORED_PRODUCTS = T.StructType([
    T.StructField("product_url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("source_store_name", T.StringType()),
    T.StructField("price", T.DecimalType(10, 2)),
    T.StructField("is_available_numeric", T.ByteType()),
    T.StructField("description_text", T.StringType()),
    T.StructField("product_category", T.StringType()),
    T.StructField("product_tags", T.StringType()),
    T.StructField("sku", T.StringType()),
    T.StructField("source_platform", T.StringType()),
    T.StructField("availability_score", T.FloatType()),
    T.StructField("price_score", T.FloatType()),
    T.StructField("final_score", T.FloatType()),
])
TOP_K_PRODUCTS = T.StructType([
    T.StructField("rank_overall", T.IntegerType()),
    T.StructField("product_url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("source_store_name", T.StringType()),
    T.StructField("final_score", T.FloatType()),
    T.StructField("source_platform", T.StringType()),
])
FLAGSHIP_PRODUCTS = T.StructType([
    T.StructField("source_store_name", T.StringType()),
    T.StructField("store_rank", T.IntegerType()),
    T.StructField("product_url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("final_score", T.FloatType()),
    T.StructField("source_platform", T.StringType()),
])
STORE_RANKINGS = T.StructType([
    T.StructField("source_store_name", T.StringType()),
    T.StructField("avg_product_score", T.FloatType()),
    T.StructField("max_product_score", T.FloatType()),
    T.StructField("source_platform", T.StringType()),
])


def stored(schema: T.StructType, stamp: str = "scraped_at") -> T.StructType:
    """A table's columns as they are stored, with the time of the write."""
    return T.StructType([*schema.fields, T.StructField(stamp, T.TimestampType())])


@dataclass(frozen=True)
class Contract:
    """NOT NULL columns, maximum lengths, the unique key and the decimals of one table."""

    not_null: tuple[str, ...] = ()
    max_length: tuple[tuple[str, int], ...] = ()
    unique: tuple[str, ...] = ()
    decimals: tuple[tuple[str, int, int], ...] = ()


PRODUCTS_CONTRACT = Contract(
    not_null=("title",),
    max_length=(("product_url", 1024), ("title", 512), ("vendor", 255), ("availability", 50),
                ("category", 255), ("store_name", 100)),
    unique=("product_url",),
    decimals=(("price", 10, 2),),
)
SCRAPED_CONTRACT = Contract(
    not_null=("title",),
    max_length=(("product_url", 1024), ("title", 255), ("price", 50), ("tag", 255), ("sku", 100),
                ("category", 100)),
    unique=("product_url",),
)
SCORED_CONTRACT = Contract(
    not_null=("product_url",),
    max_length=(("product_url", 1024), ("title", 512), ("source_store_name", 100),
                ("product_category", 255), ("sku", 100), ("source_platform", 50)),
    unique=("product_url",),
    decimals=(("price", 10, 2),),
)
TOP_K_CONTRACT = Contract(not_null=("rank_overall", "product_url"), unique=("product_url",))
FLAGSHIP_CONTRACT = Contract(not_null=("source_store_name", "store_rank", "product_url"),
                             unique=("source_store_name", "product_url"))
STORE_RANKINGS_CONTRACT = Contract(not_null=("source_store_name",), unique=("source_store_name",))
