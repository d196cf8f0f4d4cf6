"""Stored tables in Spark's own buckets, sorted by their key.

A table that is read by key again and again is written once in buckets. A join
on the key then shuffles the other side only, into as many buckets, and meets
the stored one where it lies.
"""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession, types as T

from wareloom.operators.keyed import keep_last

#: Files a table is dealt into; for large tables take about one for each 200 MB.
BUCKETS = 16


def _name(folder: str) -> str:
    return f"wareloom_{sha256(folder.encode()).hexdigest()[:32]}"


def save(df: DataFrame, folder: str, key: str, buckets: int = BUCKETS) -> None:
    """Write ``df`` to the new folder ``folder`` in buckets of ``key``, one sorted file each."""
    # Dealt like the buckets, or each task would write a file to every bucket.
    df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", folder).saveAsTable(_name(folder))


def load(spark: SparkSession, folder: str, schema: T.StructType, key: str, buckets: int = BUCKETS) -> DataFrame:
    """The table written to ``folder``, by this session or another, with its buckets."""
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(folder)} ({columns}) USING parquet "
              f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{folder}'")
    return spark.table(_name(folder)).select(*schema.names)


def fold(stored: DataFrame, recent: DataFrame, key: str = "product_url", order=("ordinal",), buckets: int = BUCKETS) -> DataFrame:
    """State after ``recent`` writes, of which the last of each key wins; ``stored`` has one row per key and stays in its buckets."""
    last = keep_last(recent, key, order).select(*stored.columns)
    # Dealt like the buckets: with more parts, Spark would deal the stored side out anew.
    written = last.select(key).repartition(buckets, key)
    return stored.join(written, key, "left_anti").select(*stored.columns).unionByName(last)
