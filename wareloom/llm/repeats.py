"""Removal of long byte strings that stand anywhere else, by merged Burrows-Wheeler transforms.

A byte goes if it lies in a string of ``window`` bytes that also starts at
another place, in the same document or another. Equal windows hold equal
grams, so each window is known by the smallest hash of its grams. Neighbouring
windows with one such hash make a piece of text. Equal pieces count as one with
a number of copies, and pieces whose hash no other place has cannot repeat and
are left out. The rest is dealt by hash into bins of a bounded size; in each the
texts are transformed in shards, the transforms merged, and the intervals of
windows that repeat read from the merged one (see ``bwt``). A piece in which its
hash stands twice may repeat itself, and is compared even where it is alone.

A hash that very many different pieces share, such as that of a frequent short
passage, is not put into one bin: its pieces are cut again by longer grams, at
last by whole windows, until few enough share one. So a group may hold any part
of all rows.

Passages of words are counted besides, as prose of many words may have less
bytes than the window: of each ``PASSAGE`` words in a row the string of ``MARK``
words with the smallest hash is a mark, and a document's marks that other rows
have too are counted. Equal passages of ``PASSAGE`` words have an equal mark, so
both documents count one at least; without ``MARK`` words in common there is
none. Nothing is removed for it.

Nulls and edge cases: a null text counts as empty; texts shorter than the
window lose nothing; rows with equal id and text are copies of each other, also
where the id is null; an empty table gives an empty result. Documents are known
by id and text, so ids may repeat. Other columns are not read. Hashes decide
only what is compared; equality of pieces is that of 128-bit digests.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from wareloom.llm import bwt
from wareloom.session import stage

WINDOW = 400
#: Lengths of the grams that windows are known by, from one round of cutting to the next; the last is the window.
GRAMS = (64, 368, 400)
#: Different pieces with one hash that are compared in one bin.
MAX_KINDS = 4096
#: Bytes of text of a bin, of a shard within it, and of what is hashed in one go.
BIN_BYTES = 1 << 21
SHARD_BYTES = 1 << 19
BLOCK = 1 << 20
#: Words of a passage that is certain to be found elsewhere, and of the marks that it is found by.
PASSAGE = 50
MARK = 32

_FACTOR = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
PIECE = "key long, digest binary, start long, windows int, again boolean"


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def of(factor: int) -> np.ndarray:
        return np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, factor, dtype=np.uint64)]), dtype=np.uint64)
    return of(_FACTOR), of(pow(_FACTOR, -1, 1 << 64))


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(1).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _hashes(values: np.ndarray, begins: np.ndarray | slice, ends: np.ndarray | slice) -> np.ndarray:
    """A 64-bit hash of the values from each of ``begins`` to its end."""
    up, down = _powers(1 << max(len(values) - 1, BLOCK).bit_length())
    sums = np.concatenate([[np.uint64(0)], np.cumsum(values * up[:len(values)], dtype=np.uint64)])
    hashes = (sums[ends] - sums[begins]) * down[:len(values)][begins]
    hashes ^= hashes >> np.uint64(32)
    hashes *= _MIX
    hashes ^= hashes >> np.uint64(32)
    return hashes


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes from each place on."""
    return _hashes(_byte_values()[data], slice(len(data) - gram + 1), slice(gram, None))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, from running minima from both ends of blocks as wide."""
    if width == 1:
        return values
    filled = np.concatenate([values, np.full(-len(values) % width, np.iinfo(np.uint64).max, dtype=np.uint64)])
    blocks = filled.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:len(values) - width + 1], ahead[width - 1:len(values)])


def _often(hashes: np.ndarray, least: np.ndarray, width: int, begin: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Whether a piece's smallest hash stands at several places in it, so that it may repeat itself."""
    # A gram is the smallest of some window if it is the largest of the least around it.
    around = np.concatenate([np.zeros(width - 1, dtype=np.uint64), least, np.zeros(width - 1, dtype=np.uint64)])
    places = np.flatnonzero(~sliding_least(~around, width) == hashes)
    values, numbers = np.unique(hashes[places], return_inverse=True)
    listed = np.sort(numbers.reshape(-1) * len(hashes) + places)
    own = np.searchsorted(values, least[begin]) * len(hashes)
    until = np.minimum(begin + windows + (width - 1), len(hashes))
    return np.searchsorted(listed, own + until) - np.searchsorted(listed, own + begin) > 1


def cut(parts: list[bytes], window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """``part, key, start, windows, again, digest`` of the pieces of each part; all parts have a window at least."""
    data = b"".join(parts)
    sizes = np.array([len(part) for part in parts], dtype=np.int64)
    begins = np.cumsum(sizes) - sizes
    width = window - gram + 1
    hashes = gram_hashes(np.frombuffer(data, dtype=np.uint8), gram)
    least = sliding_least(hashes, width)
    stops = begins + sizes - window + 1
    edges = np.unique(np.concatenate([begins, stops, np.flatnonzero(least[1:] != least[:-1]) + 1]))
    first, last = edges[:-1], edges[1:]
    part = np.searchsorted(begins, first, "right") - 1
    within = first < stops[part]
    part, first, length = part[within], first[within], (last - first)[within]
    # A text that goes on repeating itself has one hash throughout.
    times = -(-length // width)
    nth = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
    part, begin = np.repeat(part, times), np.repeat(first, times) + nth * width
    windows = np.minimum(np.repeat(first + length, times) - begin, width)
    view = memoryview(data)
    ends = begin + windows + (window - 1)
    digests = [blake2b(view[a:b], digest_size=16).digest() for a, b in zip(begin.tolist(), ends.tolist())]
    again = _often(hashes, least, width, begin, windows)
    return part, least[begin].view(np.int64), begin - begins[part], windows, again, digests


def _cutter(window: int, gram: int, names: list[str]) -> Callable:
    """Batches of rows with ``text`` to batches of their pieces, with the columns ``names`` of the rows."""
    def pieces(batch: pa.RecordBatch, held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        part, key, start, windows, again, digests = cut([text for _, _, text in held], window, gram)
        rows = pa.array([row for row, _, _ in held], pa.int64()).take(pa.array(part))
        offsets = np.array([offset for _, offset, _ in held], dtype=np.int64)
        return pa.RecordBatch.from_arrays(
            [*(batch.column(name).take(rows) for name in names), pa.array(key), pa.array(digests, pa.binary()),
             pa.array(start + offsets[part]), pa.array(windows.astype(np.int32)), pa.array(again)],
            [*names, "key", "digest", "start", "windows", "again"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple[int, int, bytes]] = []
            size = 0
            for row, value in enumerate(batch.column("text")):
                text = value.as_py()
                # Long texts are taken block by block; a window belongs to the block that it starts in.
                for offset in range(0, len(text) - window + 1, BLOCK):
                    held.append((row, offset, text[offset:offset + BLOCK + window - 1]))
                    size += len(held[-1][2])
                    if size >= BLOCK:
                        yield pieces(batch, held)
                        held, size = [], 0
            if held:
                yield pieces(batch, held)

    return run


def _cut_rows(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """Pieces of ``text``, with the other columns of ``rows``."""
    others = [field for field in rows.schema.fields if field.name != "text"]
    schema = ", ".join([*(f"{field.name} {field.dataType.simpleString()}" for field in others), PIECE])
    return rows.mapInArrow(_cutter(window, gram, [field.name for field in others]), schema)


def passage_marks(parts: list[bytes], passage: int, mark: int) -> tuple[np.ndarray, np.ndarray]:
    """``part, mark`` of the different marks of each part."""
    data = np.frombuffer(b"\n".join(parts), dtype=np.uint8)
    inside = np.concatenate([[False], (data != 32) & (data - np.uint8(9) > 4), [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begins, ends = edges[::2], edges[1::2]
    if len(begins) < passage:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    words = _hashes(_byte_values()[data], begins, ends)
    grams = _hashes(words, slice(len(words) - mark + 1), slice(mark, None))
    least = sliding_least(grams, passage - mark + 1)
    stops = np.cumsum([len(part) + 1 for part in parts])
    part = np.searchsorted(stops, begins, "right")
    whole = part[:len(least)] == part[passage - 1:]
    part, least = part[:len(least)][whole], least[whole]
    order = np.lexsort((least, part))
    part, least = part[order], least[order]
    different = np.ones(len(part), dtype=bool)
    different[1:] = (part[1:] != part[:-1]) | (least[1:] != least[:-1])
    return part[different], least[different].view(np.int64)


def _word_blocks(text: bytes, passage: int) -> Iterator[bytes]:
    """Blocks of a long text's words; passages that begin in one end in it, too."""
    size = BLOCK
    while size < len(text):
        spans = [found.span() for found in re.finditer(rb"[^\x20\x09-\x0D]+", text[:size])]
        if len(spans) <= passage:
            size *= 2
            continue
        # The last word may be cut.
        yield text[:spans[-2][1]]
        text, size = text[spans[-passage][0]:], BLOCK
    yield text


def _marker(passage: int, mark: int) -> Callable:
    """Batches of ``doc_id, body, text`` to batches of ``doc_id, body, mark``; a row gives each of its marks once."""
    def found(batch: pa.RecordBatch, rows: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        taken = pa.array(rows)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(taken), batch.column("body").take(taken), pa.array(values)], ["doc_id", "body", "mark"])

    def several(batch: pa.RecordBatch, held: list[tuple[int, bytes]]) -> pa.RecordBatch:
        part, values = passage_marks([text for _, text in held], passage, mark)
        return found(batch, np.array([row for row, _ in held], dtype=np.int64)[part], values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple[int, bytes]] = []
            size = 0
            for row, value in enumerate(batch.column("text")):
                text = value.as_py()
                if len(text) > BLOCK:
                    values = np.unique(np.concatenate([passage_marks([block], passage, mark)[1] for block in _word_blocks(text, passage)]))
                    yield found(batch, np.full(len(values), row), values)
                    continue
                held.append((row, text))
                size += len(text)
                if size >= BLOCK:
                    yield several(batch, held)
                    held, size = [], 0
            if held:
                yield several(batch, held)

    return run


def shared_marks(docs: DataFrame, passage: int = PASSAGE, mark: int = MARK) -> DataFrame:
    """``doc_id, body, n``: how many of a document's marks other rows have too; no row without any."""
    schema = "doc_id long, body long, mark long"
    placed = stage(_bodies(docs).mapInArrow(_marker(passage, mark), schema))
    often = placed.groupBy("mark").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("mark")
    # Rows that repeat with their id have the same marks, once.
    return placed.join(often, "mark", "left_semi").distinct().groupBy("doc_id", "body").agg(F.count(F.lit(1)).alias("n"))


def _bodies(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("body"), text.cast("binary").alias("text"))


def _with_text(pieces: DataFrame, bodies: DataFrame, window: int, *names: str) -> DataFrame:
    """``key, digest``, the columns ``names`` and the ``text`` of each piece, cut out of the document that stands for it."""
    carried = list(dict.fromkeys(["key", "digest", "start", "windows", *names]))
    places = {"_doc": F.col("doc_id"), "_body": F.col("body")}
    wanted = stage(pieces.withColumns(places).groupBy("_doc", "_body").agg(F.collect_list(F.struct(*carried)).alias("wanted")))
    joined = bodies.join(wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("body") == F.col("_body")))
    cuts = F.transform("wanted", lambda p: F.struct(
        p["key"].alias("key"), p["digest"].alias("digest"), *(p[n].alias(n) for n in names),
        F.substring(F.col("text"), (p["start"] + 1).cast("int"), p["windows"] + (window - 1)).alias("text")))
    # Documents that repeat with their id give each piece again.
    given = joined.select(F.inline(cuts))
    return given.groupBy("key", "digest").agg(*(F.first(n).alias(n) for n in (*names, "text")))


def _merge_bin(window: int, shard_bytes: int) -> Callable:
    def run(group: pd.DataFrame) -> pd.DataFrame:
        # The order of the strings does not matter; a fixed one makes repeated attempts equal.
        group = group.sort_values(["key", "digest"], ignore_index=True)
        marks = bwt.repeated(
            [bytes(text) for text in group["text"]], group["copies"].to_numpy(np.int64), group["windows"].to_numpy(np.int64),
            window, shard_bytes)
        found = []
        for key, digest, mark in zip(group["key"], group["digest"], marks):
            turns = np.flatnonzero(np.diff(np.concatenate([[0], mark.astype(np.int8), [0]])))
            found += [(key, digest, int(a), int(b)) for a, b in zip(turns[::2], turns[1::2])]
        return pd.DataFrame(found, columns=["key", "digest", "first", "until"])
    return run


def _mixed_ranges(mixed: DataFrame, bodies: DataFrame, window: int) -> DataFrame:
    """Ranges of the pieces that share a hash with other pieces, by merged transforms."""
    size = mixed.agg(F.sum(F.col("windows") + window)).first()[0] or 0
    bins = -(-size // BIN_BYTES) or 1
    texts = stage(_with_text(mixed, bodies, window, "windows", "copies"))
    return texts.withColumn("bin", F.pmod(F.xxhash64("key"), F.lit(bins))).groupBy("bin").applyInPandas(
        _merge_bin(window, SHARD_BYTES), "key long, digest binary, first int, until int")


def repeated_ranges(pieces: DataFrame, bodies: DataFrame, window: int = WINDOW, grams: tuple[int, ...] = GRAMS[1:],
                    max_kinds: int = MAX_KINDS) -> DataFrame:
    """``key, digest, first, until``: the ranges of a piece's windows that stand anywhere else.

    ``pieces`` are ``key, digest, copies, doc_id, body, start, windows, again``,
    one row for equal ones; ``grams`` are those still left to cut by.
    """
    kinds = pieces.groupBy("key").agg(
        F.count(F.lit(1)).alias("kinds"), F.sum("copies").alias("all"), F.bool_or("again").alias("some_again"))
    shared = stage(pieces.join(kinds.where((F.col("all") > 1) | F.col("some_again")).select("key", "kinds"), "key"))
    few = F.lit(True) if not grams else F.col("kinds") <= max_kinds
    alone = (F.col("kinds") == 1) & (F.col("copies") > 1)
    whole = shared.where(alone).select("key", "digest", F.lit(0).alias("first"), F.col("windows").alias("until"))
    ranges = whole.unionByName(_mixed_ranges(shared.where(~alone & few).drop("kinds"), bodies, window))
    many = shared.where(~alone & ~few).drop("kinds")
    if many.isEmpty():
        return ranges
    origin = _with_text(many, bodies, window, "copies", "doc_id", "body", "start").select(
        F.col("key").alias("in_key"), F.col("digest").alias("in_digest"), "copies", "doc_id", "body", F.col("start").alias("at"), "text")
    finer = stage(_cut_rows(origin, window, grams[0]))
    again = repeated_ranges(_alike(finer, F.col("at") + F.col("start"), "copies"), bodies, window, grams[1:], max_kinds)
    back = finer.select("in_key", "in_digest", "key", "digest", "start").join(again, ["key", "digest"])
    return ranges.unionByName(back.select(
        F.col("in_key").alias("key"), F.col("in_digest").alias("digest"), (F.col("start") + F.col("first")).cast("int").alias("first"),
        (F.col("start") + F.col("until")).cast("int").alias("until")))


def _alike(cuts: DataFrame, start, copies: str | None = None) -> DataFrame:
    """``key, digest, copies, doc_id, body, start, windows, again``: equal pieces as one, with a place where it stands."""
    place = F.struct("doc_id", "body", start.alias("start"), "windows", "again")
    counted = cuts.groupBy("key", "digest").agg(
        (F.sum(copies) if copies else F.count(F.lit(1))).alias("copies"), F.first(place).alias("place"))
    return counted.select("key", "digest", "copies", "place.*")


def repeated_spans(docs: DataFrame, window: int = WINDOW, grams: tuple[int, ...] = GRAMS, max_kinds: int = MAX_KINDS) -> DataFrame:
    """``doc_id, body, spans``: the byte spans, as ``from`` and ``until``, of each document that others share or that repeat in it.

    ``body`` is the hash of the text.
    """
    bodies = _bodies(docs)
    cuts = stage(_cut_rows(bodies, window, grams[0]))
    # Most hashes stand at one place only; what follows leaves them out.
    often = cuts.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bool_or("again").alias("again")).where(
        (F.col("n") > 1) | F.col("again")).select("key")
    shared = stage(cuts.join(often, "key", "left_semi"))
    ranges = repeated_ranges(stage(_alike(shared, F.col("start"))), bodies, window, grams[1:], max_kinds)
    found = shared.join(ranges, ["key", "digest"]).select(
        "doc_id", "body", (F.col("start") + F.col("first")).alias("from"), (F.col("start") + F.col("until") + (window - 1)).alias("until"))
    # Rows that repeat with their id have the same spans, once.
    spans = found.distinct()
    in_order = Window.partitionBy("doc_id", "body").orderBy("from", "until")
    reached = F.max("until").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    begun = spans.withColumn("begins", F.coalesce(F.col("from") > reached, F.lit(True)).cast("int"))
    numbered = begun.withColumn("no", F.sum("begins").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = numbered.groupBy("doc_id", "body", "no").agg(F.min("from").alias("from"), F.max("until").alias("until"))
    return joined.groupBy("doc_id", "body").agg(F.array_sort(F.collect_list(F.struct("from", "until"))).alias("spans"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, grams: tuple[int, ...] = GRAMS, max_kinds: int = MAX_KINDS,
                   passage: int = PASSAGE, mark: int = MARK) -> DataFrame:
    """``doc_id, n_bytes, spans, kept, n_shared_marks``: each document's removed spans, the bytes that are left, and its shared marks."""
    spans = repeated_spans(docs, window, grams, max_kinds)
    counted = shared_marks(docs, passage, mark)
    found = stage(spans.select("doc_id", "body", "spans", F.lit(0).cast("long").alias("n")).unionByName(
        counted.select("doc_id", "body", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"), "n")))
    # Lists of a document's places have no size bound, so they are met by a shuffle whatever the size of the table.
    listed = found.groupBy(F.col("doc_id").alias("_doc"), F.col("body").alias("_body")).agg(
        F.first("spans", ignorenulls=True).alias("_spans"), F.max("n").alias("_n")).hint("merge")
    rows = _bodies(docs)
    joined = rows.join(listed, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("body") == F.col("_body")), "left")
    size = F.octet_length("text").cast("long")
    removed = F.coalesce("_spans", F.array().cast("array<struct<from:bigint,until:bigint>>"))
    begins = F.concat(F.array(F.lit(0).cast("long")), F.transform("spans", lambda s: s["until"]))
    ends = F.concat(F.transform("spans", lambda s: s["from"]), F.array("n_bytes"))
    # Strings hold any bytes here; only they can be joined in one go.
    kept = F.zip_with(begins, ends, lambda a, b: F.substring(F.col("text"), (a + 1).cast("int"), (b - a).cast("int")).cast("string"))
    shared = F.coalesce("_n", F.lit(0).cast("long")).alias("n_shared_marks")
    return joined.select("doc_id", size.alias("n_bytes"), removed.alias("spans"), "text", shared).select(
        "doc_id", "n_bytes", "spans", F.array_join(kept, "").cast("binary").alias("kept"), "n_shared_marks")
