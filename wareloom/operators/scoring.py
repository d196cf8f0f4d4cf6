"""Attractiveness: availability flag and inverse min-max price."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wareloom.schemas import SCORE_INPUTS, WEIGHT_AVAILABILITY, WEIGHT_PRICE


def price_bounds(df: DataFrame) -> Column:
    """Smallest and largest price as one struct, a scalar subquery.

    It runs as a two-phase aggregate and reaches the rows as a literal, so
    nothing is joined or gathered.
    """
    return df.agg(F.struct(F.min("price").alias("low"), F.max("price").alias("high"))).scalar()


def price_score(price: Column, low: Column, high: Column) -> Column:
    """1 for the cheapest, 0 for the dearest; 0.5 where all prices are equal."""
    score = F.when(high == low, 0.5).otherwise((high - price) / (high - low))
    return F.coalesce(F.when(~F.isnan(score), score), F.lit(0.0))


def known_bounds(df: DataFrame) -> Column:
    """The same as a literal, worked out once for all that reads the rows afterwards."""
    row = df.agg(F.min("price").alias("low"), F.max("price").alias("high")).first()
    kind = dict(df.dtypes)["price"]
    return F.struct(F.lit(row["low"]).cast(kind).alias("low"), F.lit(row["high"]).cast(kind).alias("high"))


def add_price_score(df: DataFrame, bounds: Column | None = None) -> DataFrame:
    bounds = df.withColumn("_bounds", price_bounds(df) if bounds is None else bounds)
    return bounds.withColumn(
        "price_score", price_score(F.col("price"), F.col("_bounds.low"), F.col("_bounds.high"))).drop("_bounds")


def score(df: DataFrame, availability_weight: float = WEIGHT_AVAILABILITY,
          price_weight: float = WEIGHT_PRICE, bounds: Column | None = None) -> DataFrame:
    """Add ``availability_score``, ``price_score`` and ``final_score``.

    Without the two input columns every final score is 0.
    """
    if not set(SCORE_INPUTS) <= set(df.columns):
        return df.withColumn("final_score", F.lit(0.0))
    scored = add_price_score(df.withColumn("availability_score", F.col("is_available_numeric")), bounds)
    return scored.withColumn(
        "final_score", F.col("availability_score") * availability_weight + F.col("price_score") * price_weight)
