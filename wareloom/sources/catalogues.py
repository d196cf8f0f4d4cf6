"""Scans of the two stored catalogues into catalogue-shaped frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wareloom.schemas import (
    AVAILABLE, SCRAPED_PLATFORM, SCRAPED_PRIORITY, SCRAPED_STORE, STRUCTURED_PLATFORM, STRUCTURED_PRIORITY)


def usable(table: DataFrame) -> DataFrame:
    return table.where(F.col("price").isNotNull() & F.col("title").isNotNull())


def null_text():
    return F.lit(None).cast("string")


def scan_structured(products: DataFrame) -> DataFrame:
    """Feed catalogue: numeric price, no tags, no sku."""
    return usable(products).select(
        "product_url", "title", "vendor", "price", "availability", "description",
        F.col("category").alias("product_category"),
        F.col("store_name").alias("source_store_name"),
        F.lit(STRUCTURED_PLATFORM).alias("source_platform"),
        null_text().alias("product_tags"),
        null_text().alias("sku"),
        F.lit(STRUCTURED_PRIORITY).alias("source_priority"),
        "ordinal",
    )


def scan_scraped(products: DataFrame) -> DataFrame:
    """Page catalogue: price is text; one store, always available, no description."""
    return usable(products).select(
        "product_url", "title",
        F.lit(SCRAPED_STORE).alias("vendor"),
        "price",
        F.lit(AVAILABLE).alias("availability"),
        null_text().alias("description"),
        F.col("category").alias("product_category"),
        F.lit(SCRAPED_STORE).alias("source_store_name"),
        F.lit(SCRAPED_PLATFORM).alias("source_platform"),
        F.col("tag").alias("product_tags"),
        "sku",
        F.lit(SCRAPED_PRIORITY).alias("source_priority"),
        "ordinal",
    )
