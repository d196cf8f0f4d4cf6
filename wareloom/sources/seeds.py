"""Start points of a run: the store list and the listing categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wareloom.functions.urls import store_name
from wareloom.schemas import CATEGORY_SEEDS

# --- Fixed values: default stores and categories. --------------------------
STORES = (
    "https://www.allbirds.com",
    "https://www.brooklinen.com",
    "https://www.untuckit.com",
    "https://tattly.com",
    "https://flowrette.com",
)
CATEGORIES = (
    ("Version 1", "https://barefootbuttons.com/product-category/version-1/"),
    ("Version 2", "https://barefootbuttons.com/product-category/version-2/"),
    ("Mini", "https://barefootbuttons.com/product-category/mini/"),
    ("Tallboy", "https://barefootbuttons.com/product-category/tallboy/"),
)
# ---------------------------------------------------------------------------


def store_seeds(spark: SparkSession, stores=STORES) -> DataFrame:
    """``seed_no, base_url, store``."""
    rows = list(enumerate(stores))
    return spark.createDataFrame(rows, "seed_no long, base_url string").withColumn("store", store_name(F.col("base_url")))


def category_seeds(spark: SparkSession, categories=CATEGORIES) -> DataFrame:
    """``seed_no, category, url`` in the order the categories are walked."""
    rows = [(n, name, url) for n, (name, url) in enumerate(categories)]
    return spark.createDataFrame(rows, CATEGORY_SEEDS)
