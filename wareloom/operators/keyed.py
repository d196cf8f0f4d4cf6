"""One row per key: keep-first, keep-last and folded-key merges.

All of them shrink every key inside each task before the shuffle, so a key
that holds a large part of the rows sends one or two rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Case, accent and trailing-blank insensitive comparison.
FOLDED = "UNICODE_CI_AI_RTRIM"


def _one_per_key(df: DataFrame, key, order: list[Column]) -> DataFrame:
    keys = [key] if isinstance(key, (str, Column)) else list(key)
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).where(F.col("_position") == 1).drop("_position")


def keep_first(df: DataFrame, key="product_url", order=("source_priority", "ordinal")) -> DataFrame:
    """Earliest row of each key; NULL keys count as equal."""
    return _one_per_key(df, key, [F.col(c).asc() for c in order])


def keep_last(df: DataFrame, key="product_url", order=("ordinal",)) -> DataFrame:
    """Latest row of each key: what repeated upserts leave behind.

    The key must not be NULL, as a unique column would treat every NULL as a
    key of its own. The builders of ``product_url`` never produce one.
    """
    return _one_per_key(df, key, [F.col(c).desc() for c in order])


def folded_key(column: str, prefix: int | None = None) -> Column:
    """A key that ignores case, accents and trailing blanks, of the first ``prefix`` characters if given."""
    return F.collate(F.substring(column, 1, prefix) if prefix else F.col(column), FOLDED)


def upsert(target: DataFrame, batch: DataFrame, key="product_url", order=("ordinal",)) -> DataFrame:
    """State after writing ``batch`` over ``target``: a batch row always wins."""
    stacked = target.withColumn("_batch", F.lit(0)).unionByName(
        batch.withColumn("_batch", F.lit(1)), allowMissingColumns=True)
    return keep_last(stacked, key, ["_batch", *order]).drop("_batch")


def merge_written(rows: DataFrame, column: str = "product_url", order=("ordinal",), key: Column | None = None) -> DataFrame:
    """Upserts on ``key``, by default the whole column.

    The key column keeps the text that was written first, all other columns
    take the values written last. Each task sends at most two rows of a key.
    """
    keyed = rows.withColumn("_key", F.col(column) if key is None else key)
    by_key = Window.partitionBy("_key")
    last = _one_per_key(keyed, "_key", [F.col(c).desc() for c in order])
    if key is None:
        return last.drop("_key")
    first = keyed.withColumn("_position", F.row_number().over(by_key.orderBy(*order))).where(F.col("_position") == 1)
    first = first.select(F.col("_key").alias("_first_key"), F.col(column).alias("_written"))
    joined = last.join(first, F.col("_key").eqNullSafe(F.col("_first_key")))
    return joined.select(*[F.col("_written").alias(column) if c == column else c for c in rows.columns])
