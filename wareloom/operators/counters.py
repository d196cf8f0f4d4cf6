"""Row counts of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))


def outcome_counts(flat: DataFrame, *columns: str) -> DataFrame:
    """Accepted and rejected rows, counted apart."""
    good = F.col("reject_reason").isNull()
    return flat.groupBy(*columns).agg(
        F.count_if(good).alias("accepted"), F.count_if(~good).alias("rejected"))


def source_counts(combined: DataFrame) -> DataFrame:
    """Rows per platform, store and category."""
    return count_by(combined, "source_platform", "source_store_name", "product_category")


def frontier_counts(links: DataFrame, contents: DataFrame) -> DataFrame:
    """Distinct links of each category, and how many of them have a captured page."""
    captured = contents.select("url").distinct()
    return links.join(captured, links["link"] == captured["url"], "left").groupBy("category").agg(
        F.count("link").alias("links"), F.count("url").alias("captured"))
