"""Bringing frames of different sources to one shape."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wareloom.functions.text import clean_price
from wareloom.schemas import CATALOGUE, CATALOGUE_COLUMNS, ORDER_COLUMNS


def align(frame: DataFrame) -> DataFrame:
    """Published columns in their order, absent ones NULL, plus the order columns.

    Price becomes a number here, while its own type still says which rule
    applies: once a numeric and a text column are unioned that is lost.
    """
    types = dict(frame.dtypes)

    def column(field):
        if field.name not in types:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if field.name == "price":
            return clean_price(F.col("price"), types["price"]).alias("price")
        return F.col(field.name).cast(field.dataType).alias(field.name)

    return frame.select(*[column(f) for f in CATALOGUE.fields], *[F.col(c) for c in ORDER_COLUMNS])


def concat(frames: list[DataFrame]) -> DataFrame:
    """Stack aligned frames and drop rows that are NULL in every published column."""
    stacked = reduce(DataFrame.unionByName, frames)
    # One plain disjunction: it folds away where a column is a constant.
    any_set = reduce(Column.__or__, [F.col(c).isNotNull() for c in CATALOGUE_COLUMNS])
    return stacked.where(any_set)


def add_missing_columns(frame: DataFrame, fields) -> DataFrame:
    """Additive evolution: columns not there yet appear as NULL, others stay."""
    present = {c.lower() for c in frame.columns}
    return frame.withColumns({
        f.name: F.lit(None).cast(f.dataType) for f in fields if f.name.lower() not in present
    })


def evolve_union(older: DataFrame, newer: DataFrame) -> DataFrame:
    return older.unionByName(newer, allowMissingColumns=True)
