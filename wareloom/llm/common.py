"""Small helpers the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Rows up to which a side is broadcast: with the narrow rows used here some tens of MB.
BROADCAST_ROWS = 400_000

WORD = r"[\p{L}\p{N}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``rows`` rows; counts no further than that."""
    return df.limit(rows + 1).count() <= rows


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits; empty for a null text."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def shingles(tokens: str, size: int = 5) -> Column:
    """64-bit hashes of ``size`` words in a row; fewer words make one shingle, none make none.

    Takes the name of an array column: an expression would be worked out anew
    for every shingle.
    """
    starts = F.sequence(F.lit(1), F.greatest(F.size(tokens) - F.lit(size - 1), F.lit(1)))
    hashed = F.transform(starts, lambda at: F.xxhash64(F.slice(tokens, at, F.lit(size))))
    return F.when(F.size(tokens) > 0, hashed).otherwise(F.array().cast("array<bigint>"))
