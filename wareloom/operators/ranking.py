"""Top-k, top-n per store and store rankings.

Ranks are positions: equal scores get different ranks, decided by explicit
tie-breaks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from wareloom.functions.text import platform_or_unknown
from wareloom.schemas import FLAGSHIP_PER_STORE, TOP_K
from wareloom.session import stage

# From here on Spark no longer cuts groups down before their shuffle.
MANY = 1000
SALTS = 64
#: From here on an overall ranking is worked out in ranges.
MANY_OVERALL = 100_000
# The columns of the two reports.
TOP_K_COLUMNS = [
    "title", "source_store_name", "price", "is_available_numeric", "final_score", "product_url", "source_platform"]
FLAGSHIP_COLUMNS = ["source_store_name", "title", "final_score", "price", "product_url", "source_platform"]


def numbered(rows: DataFrame, order: list, position: str, parts: int | None = None) -> DataFrame:
    """``rows`` with their position from 1 on in ``order``, which must leave no ties; no task sees all of them.

    Rows are dealt by ranges of the order and numbered within each; what the
    ranges before hold is added.
    """
    dealt = rows.repartitionByRange(parts, *order) if parts else rows.repartitionByRange(*order)
    # Written out: the ranges come from a sample, and must be the same for counts and for numbers.
    ranged = stage(dealt.withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    # One row for each range.
    before = F.sum("_rows").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged.withColumn("_within", within).join(offsets, "_range").withColumn(
        position, F.col("_within") + F.col("_before")).drop("_range", "_within", "_before")


def _overall_order() -> list:
    return [F.desc("final_score"), F.asc("product_url")]


def rank_all(scored: DataFrame) -> DataFrame:
    """Every product with ``rank_overall``, however many there are; ties by URL. Rows are numbered range by range."""
    ranked = numbered(scored.select(*TOP_K_COLUMNS), _overall_order(), "rank_overall")
    return ranked.select(F.col("rank_overall").cast("int").alias("rank_overall"), *TOP_K_COLUMNS)


def top_k(scored: DataFrame, k: int = TOP_K) -> DataFrame:
    """The k best products with ``rank_overall``; ties by URL.

    For a small k the limit is taken first, so the ranking window sees k rows
    only. From ``MANY_OVERALL`` on, rows are numbered range by range.
    """
    if k >= MANY_OVERALL:
        return rank_all(scored).where(F.col("rank_overall") <= k)
    order = _overall_order()
    best = scored.select(*TOP_K_COLUMNS).orderBy(*order).limit(k)
    rank = F.row_number().over(Window.orderBy(*order))
    return best.select(rank.alias("rank_overall"), *TOP_K_COLUMNS)


def flagship(scored: DataFrame, n: int = FLAGSHIP_PER_STORE) -> DataFrame:
    """The n best products of each store with ``store_rank``; ties keep the earlier row."""
    order = [F.desc("final_score"), F.asc("source_priority"), F.asc("ordinal"), F.asc("product_url")]
    if n >= MANY:
        # A store is first cut to n in parts, so a huge one is not ranked by a single task.
        salt = F.pmod(F.xxhash64("product_url", "source_priority", "ordinal"), F.lit(SALTS))
        within = F.row_number().over(Window.partitionBy("source_store_name", "_salt").orderBy(*order))
        salted = scored.withColumn("_salt", salt)
        scored = salted.withColumn("_within", within).where(F.col("_within") <= n).drop("_salt", "_within")
    rank = F.row_number().over(Window.partitionBy("source_store_name").orderBy(*order))
    return scored.withColumn("store_rank", rank).where(F.col("store_rank") <= n).select("store_rank", *FLAGSHIP_COLUMNS)


def _store_parts(scored: DataFrame) -> DataFrame:
    """Scores by store and platform.

    Only numbers are aggregated, so this stays a hash aggregate, and it
    leaves a handful of rows per store for what follows.
    """
    return scored.groupBy("source_store_name", "source_platform", "source_priority").agg(
        F.sum("final_score").alias("total"),
        F.count("final_score").alias("products"),
        F.max("final_score").alias("best"),
        F.min("ordinal").alias("ordinal"),
    )


def _mean():
    return F.sum("total") / F.sum("products")


def _first_platform():
    return F.min_by("source_platform", F.struct("source_priority", "ordinal", "source_platform"))


def store_averages(scored: DataFrame) -> DataFrame:
    averages = scored.groupBy("source_store_name").agg(F.avg("final_score").alias("avg_product_score"))
    return averages.orderBy(F.desc("avg_product_score"), "source_store_name")


def store_maxima(scored: DataFrame) -> DataFrame:
    maxima = scored.groupBy("source_store_name").agg(F.max("final_score").alias("max_product_score"))
    return maxima.orderBy(F.desc("max_product_score"), "source_store_name")


def store_platforms(scored: DataFrame) -> DataFrame:
    """Platform of the first product seen of each store."""
    return _store_parts(scored).groupBy("source_store_name").agg(_first_platform().alias("source_platform"))


def attach_platforms(averages: DataFrame, maxima: DataFrame, platforms: DataFrame) -> DataFrame:
    """Align separately computed results by store; stores without a platform get a marker."""
    key = "source_store_name"
    ranked = averages.join(maxima, key, "full").join(platforms, key, "left")
    return ranked.withColumn("source_platform", platform_or_unknown(F.col("source_platform")))


def store_rankings(scored: DataFrame) -> DataFrame:
    """Mean and best score and platform of each store, in one pass over the products."""
    return _store_parts(scored).groupBy("source_store_name").agg(
        _mean().alias("avg_product_score"),
        F.max("best").alias("max_product_score"),
        platform_or_unknown(_first_platform()).alias("source_platform"),
    )
