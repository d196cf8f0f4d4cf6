"""Finding benchmark items inside documents.

Each item is compared with windows of its own number of words. A sweep over
the places of the shingles shared with items of that length counts, for every
start, the shingles that its window can share with one item; windows are
placed at all starts where the count can reach the similarity, in whatever
order the shingles stand. Windows get a 64-bit SimHash of their word shingles.
Two fingerprints that differ in at most ``radius`` bits agree in at least one
of ``radius + 1`` blocks, so an equi join on the blocks finds all pairs within
the radius. Blocks of three or four bits select little by themselves, so the
join is made within a document and only with the items of which it holds a
rare shingle: an item can lose so many of its shingles and no more, so of its
rarest ones, one more than that, some stand in every window alike to it. Pairs
are then verified by the similarity of their shingles weighted by how often
they occur.

Nulls and edge cases: null and empty texts and items without words match
nothing; items of fewer than ``size`` words make one shingle, and so do the
windows compared with them; rows that share a ``doc_id`` count as one
document in the report, while each row goes or stays by its own text, also
without an id; an item listed twice is
reported under each id; an empty table gives an empty result. A document
shorter than an item is compared as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wareloom.llm.common import is_small, shingles, words
from wareloom.session import stage

SHINGLE = 5
SIMILARITY = 0.8
#: A similarity of 0.8 means an angle of about 27 degrees, 9.7 of 64 bits on average with a deviation of 2.9.
RADIUS = 19


def simhash(window: str) -> Column:
    """SimHash of an array column of shingle hashes; repeated shingles weigh as often as they occur."""
    # Never null, or joins would test the whole expression for null once more.
    return F.expr(
        "coalesce(aggregate(transform(sequence(0, 63), b -> if(aggregate(" + window + ", 0, (total, h) ->"
        " total + if(shiftright(h, b) & 1L = 1L, 1, -1)) > 0, shiftleft(1L, b), 0L)), 0L, (bits, bit) -> bits | bit), 0L)")


def _blocks(radius: int) -> list[tuple[int, int]]:
    """``(offset, mask)`` of ``radius + 1`` blocks that cover 64 bits evenly."""
    edges = [64 * n // (radius + 1) for n in range(radius + 2)]
    return [(low, (1 << (high - low)) - 1) for low, high in zip(edges, edges[1:])]


def _block_values(bits: Column, radius: int) -> Column:
    return F.posexplode(F.array(*[
        F.shiftrightunsigned(bits, low).bitwiseAND(F.lit(mask)) for low, mask in _blocks(radius)]))


def _first_equal_block(apart: Column, radius: int) -> Column:
    """Number of the first block in which the xor of two fingerprints has no bit."""
    equal = [F.when(F.shiftrightunsigned(apart, low).bitwiseAND(F.lit(mask)) == 0, n)
             for n, (low, mask) in enumerate(_blocks(radius))]
    return F.coalesce(*equal)


def weighted_similarity(left: str, right: str) -> Column:
    """Sum of the smaller over sum of the larger weights, a shingle weighing as often as it occurs."""
    plain = f"size(array_intersect({left}, {right}))"
    counted = (f"aggregate(array_distinct({left}), 0, (total, h) -> total +"
               f" least(size(filter({left}, x -> x = h)), size(filter({right}, x -> x = h))))")
    repeats = f"size(array_distinct({left})) < size({left}) and size(array_distinct({right})) < size({right})"
    return F.expr(
        f"transform(array(if({repeats}, {counted}, {plain})),"
        f" shared -> shared / (size({left}) + size({right}) - shared))[0]")


def fingerprinted_items(benchmark: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``item_id, n_words, item, item_bits, item_key``; items of the same words share their ``item_key``."""
    items = benchmark.select("item_id", words(F.col("text")).alias("tokens"))
    items = items.where(F.size("tokens") > 0).select(
        "item_id", F.size("tokens").alias("n_words"), shingles("tokens", size).alias("item"))
    return items.withColumns({"item_bits": simhash("item"), "item_key": F.xxhash64("n_words", "item")})


def _length(n_words: Column | str, size: int) -> Column:
    """Number of shingles of so many words."""
    return F.greatest(F.col(n_words) - (size - 1), F.lit(1))


def _hits(docs: DataFrame, items: DataFrame, size: int, small: bool) -> DataFrame:
    """``doc_id, key, n_tokens, n_words, h, often, pos``: where documents hold shingles of items of ``n_words`` words.

    ``often`` is how often one item holds the shingle at most. ``key`` is the text's hash.
    """
    listed = (
        items.select("item_id", "n_words", F.explode("item").alias("h"))
        .groupBy("item_id", "n_words", "h").agg(F.count(F.lit(1)).alias("often"))
        .groupBy("n_words", "h").agg(F.max("often").cast("int").alias("often"))
    )
    # Short items need shingles of their own number of words.
    sizes = [r[0] for r in items.select(F.least("n_words", F.lit(size)).alias("k")).distinct().orderBy(F.desc("k")).collect()]
    sizes = sizes or [size]
    texts = docs.select("doc_id", F.xxhash64("text").alias("key"), words(F.col("text")).alias("tokens"))
    # The outer form keeps Spark from working out the shingles a second time to test for empty ones.
    placed = texts.select("doc_id", "key", F.size("tokens").alias("n_tokens"), F.posexplode_outer(
        F.concat(*[shingles("tokens", k) for k in sizes])).alias("pos", "h"))
    # The shingles of each number of words begin after those of the larger numbers.
    begin, before = F.lit(0), F.lit(0)
    for k in sizes:
        begin = F.when(F.least("n_words", F.lit(size)) == k, before).otherwise(begin)
        before = before + _length("n_tokens", k)
    hits = placed.join(F.broadcast(listed) if small else listed, "h").withColumn("pos", F.col("pos") - begin)
    return hits.where((F.col("pos") >= 0) & (F.col("pos") + F.least("n_words", F.lit(size)) <= F.col("n_tokens")))


def _starts(hits: DataFrame, size: int, similarity: float) -> DataFrame:
    """``doc_id, key, n_words, start``: all starts whose window can be alike to an item of ``n_words`` words.

    A shingle counts for the windows that hold it, but for those that hold it
    ``often`` times before.
    """
    length = _length("n_words", size)
    places = hits.groupBy("doc_id", "key", "n_tokens", "n_words", "h", "often").agg(
        F.sort_array(F.collect_set("pos")).alias("places"))
    changes = places.select("doc_id", "key", "n_tokens", "n_words", length.alias("length"), F.explode(F.expr(
        f"transform(places, (p, i) -> struct(greatest(if(i >= often, places[i - often] + 1, 0),"
        f" p - greatest(n_words - {size - 1}, 1) + 1, 0) AS first, p AS last))")).alias("p"))
    changes = changes.select("doc_id", "key", "n_tokens", "n_words", "length", F.explode(F.array(
        F.struct(F.col("p.first").alias("start"), F.lit(1).alias("change")),
        F.struct((F.col("p.last") + 1).alias("start"), F.lit(-1).alias("change")))).alias("c"))
    steps = changes.groupBy("doc_id", "key", "n_tokens", "n_words", "length", F.col("c.start").alias("start")).agg(
        F.sum("c.change").alias("change"))
    order = Window.partitionBy("doc_id", "key", "n_tokens", "n_words", "length").orderBy("start")
    steps = steps.select("doc_id", "key", "n_tokens", "n_words", "length", "start",
                         F.sum("change").over(order).alias("shared"), F.lead("start").over(order).alias("following"))
    in_doc = _length("n_tokens", size)
    last = F.least(F.col("following") - 1, F.greatest(F.col("n_tokens") - F.col("n_words"), F.lit(0)))
    # Shared over all, shared counted once, is at least the similarity.
    enough = F.col("shared") * (1 + similarity) >= similarity * (F.col("length") + F.least("length", in_doc)) - 1e-6
    return steps.where(enough & (F.col("start") <= last)).select(
        "doc_id", "key", "n_words", F.explode(F.sequence("start", last)).alias("start"))


def windows(docs: DataFrame, items: DataFrame, size: int = SHINGLE, small: bool = True,
            similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, key, n_words, start, window``: all item-sized windows that can be alike to an item.

    With few items their shingles are broadcast, otherwise hits are found by a
    shuffle of narrow rows. The documents that have windows are joined back.
    """
    starts = _starts(_hits(docs, items, size, small), size, similarity)
    found = stage(starts.groupBy(F.col("doc_id").alias("found_in"), F.col("key").alias("found_key")).agg(
        F.collect_list(F.struct("n_words", "start")).alias("found")))
    same = F.col("doc_id").eqNullSafe(F.col("found_in")) & (F.col("key") == F.col("found_key"))
    texts = docs.select("doc_id", F.xxhash64("text").alias("key"), "text").join(found, same)
    placed = texts.select("doc_id", "key", words(F.col("text")).alias("tokens"), "found").select(
        "doc_id", "key", "tokens", F.inline("found"))
    parts = placed.select("doc_id", "key", "n_words", "start", F.slice("tokens", F.col("start") + 1, F.col("n_words")).alias("part"))
    return parts.select("doc_id", "key", "n_words", "start", shingles("part", size).alias("window"))


def rare_shingles(items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``item_key, n_words, h``: shingles of each item of which every window alike to it holds one.

    Shingles that few items of the same length hold come first. A window of the
    wanted similarity shares that part of the item's shingles at least.
    """
    texts = items.dropDuplicates(["item_key"])
    held = texts.select("item_key", "n_words", F.explode("item").alias("h"))
    holders = held.groupBy("n_words", "h").agg(F.count_distinct("item_key").alias("holders"))
    ranked = held.join(holders, ["n_words", "h"]).groupBy("item_key", "n_words").agg(
        F.sort_array(F.collect_list(F.struct("holders", "h"))).alias("ranked"))
    spare = F.size("ranked") - F.ceil(F.size("ranked") * similarity - 1e-6).cast("int") + 1
    return ranked.select("item_key", "n_words", F.explode(F.array_distinct(F.slice("ranked", F.lit(1), spare)["h"])).alias("h"))


def candidates(seen: DataFrame, rare: DataFrame, small: bool = True) -> DataFrame:
    """``place, n_words, item_key``: the items of which a document's windows hold a rare shingle."""
    shared = seen.select("place", "n_words", F.explode("window").alias("h")).distinct()
    return shared.join(F.broadcast(rare) if small else rare, ["n_words", "h"]).select("place", "n_words", "item_key").distinct()


def alike_windows(docs: DataFrame, benchmark: DataFrame, size: int = SHINGLE, similarity: float = SIMILARITY,
                  radius: int = RADIUS) -> DataFrame:
    """``doc_id, key, item_id, similarity, start``: the windows that are alike to an item; ``key`` is the text's hash."""
    items = stage(fingerprinted_items(benchmark, size))
    small = is_small(items.select(F.explode("item")))
    listed = items.dropDuplicates(["item_key"]).drop("item_id", "n_words")
    seen = windows(docs, items, size, small, similarity).withColumn("bits", simhash("window"))
    # Unlike columns, structs with a null in the same place are equal, so rows without an id meet too.
    seen = stage(seen.withColumn("place", F.struct("doc_id", "key")))
    met = candidates(seen, stage(rare_shingles(items, similarity)), small)
    bits = listed.select("item_key", "item_bits")
    met = met.join(F.broadcast(bits) if small else bits, "item_key")
    left = seen.select("place", "n_words", "start", "bits", _block_values(F.col("bits"), radius).alias("block", "value"))
    right = met.select("place", "n_words", "item_key", "item_bits", _block_values(F.col("item_bits"), radius).alias("block", "value"))
    apart = F.col("bits").bitwiseXOR(F.col("item_bits"))
    near = left.join(right, ["place", "n_words", "block", "value"]).where(
        (F.bit_count(apart) <= radius) & (F.col("block") == _first_equal_block(apart, radius)))
    pairs = near.select("place", "n_words", "start", "item_key").distinct()
    texts = listed.select("item_key", "item")
    scored = pairs.join(seen.select("place", "n_words", "start", "window"), ["place", "n_words", "start"]).join(
        F.broadcast(texts) if small else texts, "item_key").select(
        "place", "start", "item_key", weighted_similarity("window", "item").alias("similarity"))
    ids = items.select("item_key", "item_id")
    return scored.where(F.col("similarity") >= similarity).join(F.broadcast(ids) if small else ids, "item_key").select(
        "place.doc_id", "place.key", "item_id", "similarity", "start")


def contaminated(docs: DataFrame, benchmark: DataFrame, size: int = SHINGLE, similarity: float = SIMILARITY,
                 radius: int = RADIUS) -> DataFrame:
    """``doc_id, item_id, similarity, start``: the best window of each document and item that are alike.

    ``start`` is the window's first word, the earliest of equally good ones.
    """
    return alike_windows(docs, benchmark, size, similarity, radius).groupBy("doc_id", "item_id").agg(
        F.max("similarity").alias("similarity"), F.min_by("start", F.struct(-F.col("similarity"), "start")).alias("start"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item, those without an id among them."""
    held = alike_windows(docs, benchmark).select(F.col("doc_id").alias("_held"), F.col("key").alias("_text")).distinct()
    return docs.join(held, docs["doc_id"].eqNullSafe(held["_held"]) & (F.xxhash64(docs["text"]) == held["_text"]), "left_anti")
