"""How far the sources of a language differ in the terms they use.

Tasks count terms per language and source as they read, and write a term's
counts with its text and a 64-bit digest. All that follows is shuffled by
digest; the texts stay in the written table, from which a column that is not
asked for is not read. Once the digests that are frequent enough are known,
the smallest and largest text of each tell whether two terms share it; those
few are split by text. Texts are joined back for the terms that are put out.

A group's share of a term is ``p = 1 + floor(10^9 (count + 2) / (N + 2 V))``,
and two shares are ``floor((p - q)^2 / (p + q))`` apart; both are whole numbers
and worked out exactly. Terms that neither of two sources has all add the same
amount, so only counts above nought are ever kept. Sources are compared block
by block and terms bucket by bucket, so no task holds all of either.

Nulls and edge cases: a null text, lang or source is the empty string; every
row counts as a document of its own, also where ids repeat or rows are equal; a
language without kept terms has distances of nought; one with a single source
gives no pairs; an empty table gives an empty result; equal values rank by the
item's bytes. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from decimal import Decimal
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from wareloom.session import stage

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
DIGEST_BITS = 64
#: Counts a task holds before it hands them on, and bytes of text it looks at in one go.
HELD_COUNTS = 1_000_000
SLICE = 1 << 22
#: Sources and terms that one task compares.
BLOCK_SOURCES = 128
BUCKET_TERMS = 2000

# Fixed value: letters, and everything beyond ASCII, of which UTF-8 has bytes from 80 on only.
TERM = re.compile(rb"[a-z\x80-\xff]+")
BREAK = re.compile(rb"[^a-z\x80-\xff]")

COUNTS = "lang string, digest long, term string, docs long, sources array<string>, ns array<long>"
COUNTS_ARROW = pa.schema([("lang", pa.string()), ("digest", pa.int64()), ("term", pa.string()), ("docs", pa.int64()),
                          ("sources", pa.list_(pa.string())), ("ns", pa.list_(pa.int64()))])
PAIRS = "lang string, source string, item string, value decimal(38,0), seen long, apart long, terms long"


def digest_of(term: bytes, bits: int = DIGEST_BITS) -> int:
    return int.from_bytes(blake2b(term, digest_size=8).digest(), "big", signed=True) >> (64 - bits)


def _term_lists(text: bytes) -> Iterator[list[bytes]]:
    """A text's terms, some megabytes at a time; cut where no term is."""
    text = text.lower()  # Of bytes, this changes A to Z only.
    start = 0
    while start < len(text):
        gap = BREAK.search(text, start + SLICE)
        end = gap.start() if gap else len(text)
        yield TERM.findall(text, start, end)
        start = end


def _as_batch(lang: str, docs: Counter, by_source: dict[str, Counter], bits: int) -> pa.RecordBatch:
    """One row per term, with its count in each source that has it; and one without a term, for sources that have none."""
    terms = list(docs)
    places = {term: n for n, term in enumerate(terms)}
    rows = np.concatenate([np.full(len(by_source), len(terms)), *(
        np.fromiter((places[t] for t in counts), np.int64, len(counts)) for counts in by_source.values())])
    ns = np.concatenate([np.zeros(len(by_source), dtype=np.int64), *(
        np.fromiter(counts.values(), np.int64, len(counts)) for counts in by_source.values())])
    owners = np.concatenate([np.arange(len(by_source)), np.repeat(
        np.arange(len(by_source)), [len(counts) for counts in by_source.values()])])
    order = np.argsort(rows, kind="stable")
    offsets = pa.array(np.searchsorted(rows[order], np.arange(len(terms) + 2)), pa.int32())
    sources = pa.array(list(by_source), pa.string()).take(pa.array(owners[order]))
    return pa.RecordBatch.from_arrays([
        pa.array([lang] * (len(terms) + 1), pa.string()), pa.array([*(digest_of(t, bits) for t in terms), None], pa.int64()),
        pa.array([*terms, None], pa.binary()).cast(pa.string()), pa.array([*docs.values(), 0], pa.int64()),
        pa.ListArray.from_arrays(offsets, sources), pa.ListArray.from_arrays(offsets, pa.array(ns[order]))], schema=COUNTS_ARROW)


def _counter(bits: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: dict[str, Counter] = {}
        counts: dict[str, dict[str, Counter]] = {}
        held = 0
        for batch in batches:
            for lang, source, value in zip(*(batch.column(name).to_pylist() for name in ("lang", "source")), batch.column("text")):
                in_lang = docs.setdefault(lang, Counter())
                in_source = counts.setdefault(lang, {}).setdefault(source, Counter())
                before = len(in_source)
                distinct: set[bytes] = set()
                for terms in _term_lists(value.as_py()):
                    in_source.update(terms)
                    distinct.update(terms)
                in_lang.update(distinct)
                held += len(in_source) - before + 1
                if held > HELD_COUNTS:
                    yield from (_as_batch(l, docs[l], counts[l], bits) for l in docs)
                    docs, counts, held = {}, {}, 0
        yield from (_as_batch(l, docs[l], counts[l], bits) for l in docs)

    return run


def term_counts(docs: DataFrame, bits: int = DIGEST_BITS) -> DataFrame:
    """``lang, digest, term, docs, sources, ns``: counts as tasks have made them; a term may come in several rows.

    Rows without a term name the sources of a language.
    """
    named = [F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]
    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    return docs.select(*named, text).mapInArrow(_counter(bits), COUNTS)


def _by_source(counts: DataFrame, *names: str) -> DataFrame:
    given = F.inline(F.arrays_zip(F.col("sources").alias("source"), F.col("ns").alias("n")))
    return counts.select("lang", "digest", *names, given)


def kept_counts(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, source, digest, split, n``: how often each source has the terms its language keeps.

    ``split`` is the term itself where others share its digest, else empty.
    Tells terms apart as the texts would, by digests alone.
    """
    key = ["lang", "digest"]
    found = counts.where(F.col("digest").isNotNull())
    frequent = stage(found.groupBy(*key).agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).drop("docs"))
    shared = stage(
        found.join(frequent, key, "left_semi").groupBy(*key).agg(F.min("term").alias("least"), F.max("term").alias("most"))
        .where(F.col("least") < F.col("most")).select(*key))
    plain = (
        _by_source(found.join(frequent.join(shared, key, "left_anti"), key, "left_semi"))
        .groupBy("lang", "source", "digest").agg(F.sum("n").alias("n"))
        .select("lang", "source", "digest", F.lit("").alias("split"), "n"))
    apart = found.join(shared, key, "left_semi").withColumnRenamed("term", "split")
    still = apart.groupBy(*key, "split").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    split = (
        _by_source(apart.join(still.drop("docs"), [*key, "split"], "left_semi"), "split")
        .groupBy("lang", "source", "digest", "split").agg(F.sum("n").alias("n")))
    return plain.unionByName(split)


def share(n: Column, total: Column, terms: Column) -> Column:
    """``p`` in whole numbers; a count times the scale may be more than a long holds."""
    scaled = F.lit(SCALE).cast("decimal(10,0)") * (n.cast("decimal(20,0)") + 2)
    whole = total.cast("decimal(20,0)") + 2 * terms.cast("decimal(19,0)")
    return F.floor(F.call_function("div", scaled, F.nullif(whole, F.lit(0).cast("decimal(1,0)")))).cast("long") + 1


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def groups(counts: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang, source, total, terms, lang_total, none, sources``: one row per group, ``none`` its share of a term it lacks."""
    every = counts.where(F.col("digest").isNull()).select("lang", F.explode("sources").alias("source")).distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_lang = (
        kept.groupBy("lang", "digest", "split").agg(F.sum("n").alias("n"))
        .groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n").alias("lang_total")))
    sources = every.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    joined = every.join(totals, ["lang", "source"], "left").join(by_lang, "lang", "left").join(sources, "lang")
    filled = joined.na.fill(0, ["total", "terms", "lang_total"])
    none = F.coalesce(share(F.lit(0), F.col("total"), F.col("terms")), F.lit(1))
    return filled.withColumn("none", none)


def _distances(key: tuple, members: pd.DataFrame, shares: pd.DataFrame) -> pd.DataFrame:
    """Sums over one bucket of terms, for the pairs of sources of two blocks."""
    lang, low, high = key[0], key[1], key[2]
    sides = [members[members["block"] == low], members[members["block"] == high]]
    # Row by term, column by source, filled with the share of a term that the source lacks.
    terms = shares.groupby(["digest", "split"], sort=False).ngroup().to_numpy(np.int64)
    count = int(terms.max(initial=-1)) + 1
    grids = []
    for side in sides:
        column = {source: n for n, source in enumerate(side["source"])}
        grid = np.tile(side["none"].to_numpy(np.int64), (count, 1))
        at = shares["source"].map(column)
        here = at.notna().to_numpy()
        grid[terms[here], at[here].astype(int)] = shares["p"].to_numpy(np.int64)[here]
        grids.append(grid)
    found = []
    (left, right), (mine, other) = sides, grids
    for n, (source, none) in enumerate(zip(left["source"], left["none"])):
        p = mine[:, n:n + 1]
        sums = ((p - other) ** 2 // (p + other)).sum(axis=0)
        for item, value, beyond in zip(right["source"], sums.tolist(), right["none"].tolist()):
            if item != source:
                found.append((source, item, value, (none - beyond) ** 2 // (none + beyond)))
                if low != high:
                    found.append((item, source, value, (none - beyond) ** 2 // (none + beyond)))
    total = int(members["terms"].iloc[0]) if len(members) else 0
    return pd.DataFrame(
        [(lang, source, item, Decimal(value), count, beyond, total) for source, item, value, beyond in found],
        columns=[field.split()[0] for field in PAIRS.replace("decimal(38,0)", "decimal").split(", ")])


def source_pairs(shares: DataFrame, group_table: DataFrame) -> DataFrame:
    """``lang, source, item, value``: how far each source is from each other one of its language."""
    blocks = F.ceil(F.col("sources") / BLOCK_SOURCES)
    placed = group_table.withColumn("block", F.pmod(F.xxhash64("source"), blocks))
    buckets = F.greatest(F.ceil(F.col("terms") / BUCKET_TERMS), F.lit(1))
    members = placed.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), buckets - 1)))
    rows = shares.join(placed.select("lang", "source", "block", "sources", "terms"), ["lang", "source"]).withColumn(
        "bucket", F.pmod(F.col("digest"), buckets))

    def dealt(df: DataFrame) -> DataFrame:
        other = df.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        return other.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))

    keys = ["lang", "low", "high", "bucket"]
    members = dealt(members).select(*keys, "source", "block", "none", "terms")
    rows = dealt(rows).select(*keys, "source", "digest", "split", "p")
    summed = members.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(_distances, PAIRS)
    # Terms that neither source of a block pair has are in no bucket's sum.
    value = F.sum("value") + (F.max("terms") - F.sum("seen")) * F.max("apart")
    return summed.groupBy("lang", "source", "item").agg(value.cast("long").alias("value"))


def top_terms(shares: DataFrame, counts: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, item, value, rank``: the terms a source has more of than its language."""
    more = shares.where(F.col("p") > F.col("q")).select(
        "lang", "source", "digest", "split", apart(F.col("p"), F.col("q")).alias("value"))
    # All that tie with the last one stay until the texts are there to tell.
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    best = stage(more.withColumn("_rank", F.rank().over(by_value)).where(F.col("_rank") <= top).drop("_rank"))
    wanted = best.where(F.col("split") == "").select("lang", "digest").distinct()
    texts = (
        counts.select("lang", "digest", "term").join(wanted, ["lang", "digest"], "left_semi")
        .groupBy("lang", "digest").agg(F.min("term").alias("text")))
    named = best.join(texts, ["lang", "digest"], "left").withColumn(
        "item", F.when(F.col("split") == "", F.col("text")).otherwise(F.col("split")))
    by_text = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return named.withColumn("rank", F.row_number().over(by_text)).where(F.col("rank") <= top).select(
        "lang", "source", "item", "value", "rank")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, bits: int = DIGEST_BITS) -> DataFrame:
    """``lang, source, part, item, value, rank``: each source against the others and against its language."""
    counts = stage(term_counts(docs, bits))
    kept = stage(kept_counts(counts, min_docs))
    group_table = stage(groups(counts, kept))
    by_term = kept.groupBy("lang", "digest", "split").agg(F.sum("n").alias("lang_n"))
    shares = stage(
        kept.join(by_term, ["lang", "digest", "split"]).join(
            group_table.select("lang", "source", "total", "terms", "lang_total"), ["lang", "source"])
        .select("lang", "source", "digest", "split", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
                share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q")))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = source_pairs(shares, group_table).withColumn("rank", F.row_number().over(by_value))
    parts = pairs.withColumn("part", F.lit("pair")).unionByName(top_terms(shares, counts, top).withColumn("part", F.lit("term")))
    return parts.select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))
