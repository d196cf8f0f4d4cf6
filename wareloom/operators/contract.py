"""Checking frames against a declared contract, and the shape results are saved in."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from wareloom.functions.text import fill
from wareloom.schemas import Contract


def _row_rules(contract: Contract, columns) -> list[tuple[str, str, Column]]:
    """``(rule, column, broken)`` for each rule one row can break by itself."""
    rules = [("not null", c, F.col(c).isNull()) for c in contract.not_null]
    rules += [(f"length <= {n}", c, F.char_length(F.col(c)) > n) for c, n in contract.max_length]
    rules += [
        (f"decimal({p},{s})", c, F.col(c).isNotNull() & F.col(c).cast("double").try_cast(T.DecimalType(p, s)).isNull())
        for c, p, s in contract.decimals
    ]
    return [rule for rule in rules if rule[1] in columns]


def broken_rule(contract: Contract, columns, lengths: bool = False) -> Column:
    """Name of the first rule a row breaks, NULL for a good row.

    Lengths cost no row its place, as the columns hold any text; they are
    reported by ``contract_violations``, and only count here if asked for.
    """
    named = [F.when(broken, f"{column}: {rule}") for rule, column, broken in _row_rules(contract, columns)
             if lengths or not rule.startswith("length")]
    return F.coalesce(*named, F.lit(None).cast("string"))


def split_by_contract(df: DataFrame, contract: Contract, lengths: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows that fit, and the others with their ``reject_reason``."""
    marked = df.withColumn("reject_reason", broken_rule(contract, df.columns, lengths))
    good = marked.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return good, marked.where(F.col("reject_reason").isNotNull())


def contract_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """``column_name, rule, violations``: one row per rule, also where it holds.

    Rows are counted per unique key and rule, first inside each task, and the
    counts per key are then added up, so one pass answers all rules. NULL keys
    are distinct, as in a unique index.
    """
    rules = _row_rules(contract, df.columns)
    names = [f"r{n}" for n in range(len(rules))]
    broken = [F.count_if(broken).alias(name) for name, (_, _, broken) in zip(names, rules)]
    counted = df.groupBy(*contract.unique).agg(F.count(F.lit(1)).alias("rows"), *broken)
    keyed = reduce(Column.__and__, [F.col(c).isNotNull() for c in contract.unique], F.lit(True))
    repeats = F.sum(F.when(keyed, F.col("rows") - 1).otherwise(0))
    totals = counted.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names],
                         F.coalesce(repeats, F.lit(0)).alias("repeats"))
    listed = [(column, rule, name) for name, (rule, column, _) in zip(names, rules)]
    if contract.unique:
        listed.append((", ".join(contract.unique), "unique", "repeats"))
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(column).alias("column_name"), F.lit(rule).alias("rule"), F.col(name).alias("violations"))
        for column, rule, name in listed
    ])))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns and types; numbers that do not fit become NULL."""
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


SAVED_NUMBERS = ["price", "availability_score", "price_score", "final_score"]
SAVED_TEXTS = ["product_url", "title", "source_store_name", "description_text", "product_category", "product_tags",
               "sku", "source_platform"]


def save_shape(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns of the scored table: absent ones NULL, NaN to NULL, missing text marked."""
    present = set(df.columns)

    def column(name):
        value = F.col(name) if name in present else F.lit(None)
        if name in SAVED_TEXTS:
            return fill(value.cast("string"))
        if name in SAVED_NUMBERS:
            number = value.cast("double")
            return F.when(~F.isnan(number), number)
        return value if name in present else value.cast("int")

    return df.select(*[column(c).alias(c) for c in columns])
