"""Removal of lines that many sites share.

The spread of a line is the number of distinct sites it stands on. One
HyperLogLog sketch for each line hash, merged by aggregation, estimates it
for all lines; lines whose estimate is close to the threshold are counted
exactly. Lines at or above the threshold go from every document but the first.

Nulls and edge cases: a null text stays null; a null site is no site; a row
with a null ``doc_id`` counts but keeps its text; blank lines and lines of
fewer than ``min_words`` words are never boilerplate; an empty table gives an
empty result. Rows that share a ``doc_id`` are treated as one document. Lines
are known by a 64-bit hash of their trimmed text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wareloom.session import stage

MIN_SITES = 5
MIN_WORDS = 1
#: log2 of the sketch's registers: a standard error of about 1.6 %.
LG_K = 12
#: Share of the threshold within which lines are counted exactly: over six standard errors.
NEAR = 0.1


def _split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(" \t\r")))


def line_sites(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, site, line``: each document's distinct lines of enough words, as hashes."""
    # Anchored and possessive, so a long line without blanks is read once.
    enough = rf"^\s*+(?:\S++\s++){{{min_words - 1}}}\S"
    lines = F.filter(_split(F.col("text")), lambda line: line.rlike(enough))
    return docs.select(
        "doc_id", F.col("source").alias("site"), F.explode(F.array_distinct(F.transform(lines, _key))).alias("line"))


def spread(lines: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """``line, sites, first_doc``: estimated number of sites and the first document of each line."""
    sketched = lines.groupBy("line").agg(
        F.hll_sketch_agg("site", lg_k).alias("sketch"), F.min("doc_id").alias("first_doc"))
    return sketched.select("line", F.hll_sketch_estimate("sketch").alias("sites"), "first_doc")


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, near: float = NEAR, lg_k: int = LG_K) -> DataFrame:
    """``line, first_doc`` of the lines on at least ``min_sites`` sites."""
    slack = max(1.0, near * min_sites)
    spreads = stage(spread(lines, lg_k).where(F.col("sites") >= min_sites - slack))
    clear = spreads.where(F.col("sites") > min_sites + slack)
    close = spreads.where(F.col("sites") <= min_sites + slack)
    exact = (
        lines.join(close.select("line"), "line", "left_semi")
        .groupBy("line").agg(F.count_distinct("site").alias("exact"))
        .where(F.col("exact") >= min_sites)
    )
    return clear.unionByName(close.join(exact.select("line"), "line", "left_semi")).select("line", "first_doc")


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, min_words: int = MIN_WORDS) -> DataFrame:
    """``row, text, n_lines, n_removed, emptied``: each row of ``docs`` as a struct and its cleaned text.

    ``emptied`` tells documents that had words and lost all of them.
    """
    lines = stage(line_sites(docs, min_words))
    listed = boilerplate(lines, min_sites).withColumnRenamed("line", "listed")
    marked = (
        lines.join(listed, F.col("line") == F.col("listed"))
        .where(F.col("doc_id") > F.col("first_doc"))
        .groupBy(F.col("doc_id").alias("marked_doc")).agg(F.collect_set("line").alias("marked"))
    )
    rows = docs.select(F.struct("*").alias("row"))
    joined = rows.join(marked, F.col("row.doc_id") == F.col("marked_doc"), "left")
    text = F.col("row.text")
    every = _split(text)
    kept = F.filter(every, lambda line: ~F.array_contains("marked", _key(line)))
    touched = F.col("marked").isNotNull() & text.isNotNull()
    made = joined.select(
        "row", F.when(touched, F.array_join(kept, "\n")).otherwise(text).alias("text"),
        F.when(text.isNull(), 0).otherwise(F.size(every)).cast("long").alias("n_lines"),
        F.when(touched, F.size(every) - F.size(kept)).otherwise(0).cast("long").alias("n_removed"))
    return made.withColumn("emptied", (F.col("n_removed") > 0) & ~F.col("text").rlike(r"\S"))


def clean(docs: DataFrame, min_sites: int = MIN_SITES, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with cleaned ``text`` and its ``n_chars``, without the documents that lost all their words."""
    made = remove_boilerplate(docs, min_sites, min_words).where(~F.coalesce("emptied", F.lit(False)))
    new = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return made.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
