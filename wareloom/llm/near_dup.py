"""Near copies by Order MinHash, verified by banded alignment.

A text is the sequence of its five-word shingles, each labelled with how often
it has occurred before. A sketch draws the ``SHORT`` shingles with the smallest
hashes and keeps them in text order, so it tells moved passages apart; texts
that share one of ``SKETCHES`` sketches are candidates. A candidate pair is
verified by aligning the two sequences inside the band that the wanted
similarity allows: aligned shingles over all shingles of both.

Equal word sequences are collapsed first. In each bucket of a sketch every text
is compared with the bucket's hub only, the text that shares the most buckets
with others. What is left open are pairs below one hub of which one text at
least failed. They are measured by the shingles that half of the hub's texts
have: two texts can only be alike if either shares enough with those by number,
or if both share others. Both kinds are looked up by equi joins, and the few
pairs they leave are compared too. So every pair of candidates that could link
two classes is compared, without comparing all pairs of a bucket.

Nulls and edge cases: a null text counts as empty; texts without words are
copies of each other if they are equal; texts of fewer than five words make one
shingle; the class id is the smallest ``doc_id`` of the class, null only where
no row of it has an id; rows are never merged; an empty table gives an empty
result. Texts are known by 64-bit hashes.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from wareloom.session import stage

SHINGLE = 5
SIMILARITY = 0.8
#: At a similarity of 0.8 a sketch is shared with a chance of about 0.8 ** 4 = 0.41, one of 20 with 0.99997.
SKETCHES = 20
SHORT = 4
#: Rounds of hubs; the later ones only serve to join what failed against an earlier hub into classes.
ROUNDS = 2

_WORD = re.compile(r"[^\W_]+")
_MASK = (1 << 64) - 1
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Hashes(dict):
    """Hash of each word met so far."""

    def __missing__(self, word):
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _A
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


def labelled_shingles(text: str, hashes: dict, size: int = SHINGLE) -> np.ndarray:
    """Distinct 64-bit hashes of (shingle, how often it came before), in text order."""
    codes = np.array([hashes[word] for word in _WORD.findall(text.lower())], np.uint64)
    if not len(codes):
        return codes
    count = max(len(codes) - size + 1, 1)
    made = np.zeros(count, np.uint64)
    for n in range(min(size, len(codes))):
        made = _mix(made + codes[n:n + count])
    order = np.argsort(made, kind="stable")
    ranked = made[order]
    begins = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    if begins.all():
        return made
    at = np.arange(count)
    before = np.empty(count, np.uint64)
    before[order] = at - np.maximum.accumulate(np.where(begins, at, 0))
    return np.where(before > 0, _mix(made + before * _B), made)


#: An odd factor and a summand per sketch: two-universal hashes of shingles that are hashes already.
_DRAWS = np.random.default_rng(20).integers(0, 1 << 64, (2, 256), np.uint64)
_FACTORS, _SUMMANDS = _DRAWS[0] | np.uint64(1), _DRAWS[1]
#: Hashes held at a time.
_AT_ONCE = 1 << 20


def sketches(shingles: np.ndarray, number: int = SKETCHES, short: int = SHORT) -> np.ndarray:
    """One 64-bit key per sketch: the smallest shingles under its hash, in text order."""
    keys = np.arange(number, dtype=np.uint64)
    several = max(_AT_ONCE // max(len(shingles), 1), 1)
    for begin in range(0, number, several):
        own = slice(begin, min(begin + several, number))
        if len(shingles) > short:
            drawn = shingles[None, :] * _FACTORS[own, None] + _SUMMANDS[own, None]
            least = shingles[np.sort(np.argpartition(drawn, short - 1, axis=1)[:, :short], axis=1)]
        else:
            least = np.broadcast_to(shingles, (own.stop - own.start, len(shingles)))
        for place in range(least.shape[1]):
            keys[own] = _mix(keys[own] * _B + least[:, place])
    return keys


def _text_hash(text: str, shingles: np.ndarray) -> int:
    """Of the words in order; of the text itself where it has none."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes() if len(shingles) else b"\0" + text.encode())


def _signed(values) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64))


def _sketcher(number: int, short: int) -> Callable:
    def run(batches):
        hashes = _Hashes()
        for batch in batches:
            nodes, keys = [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                shingles = labelled_shingles(text, hashes)
                nodes.append(_text_hash(text, shingles))
                keys.append(sketches(shingles, number, short).view(np.int64) if len(shingles) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("body"), _signed(nodes), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "body", "node", "keys"])
    return run


def sketch(docs: DataFrame, number: int = SKETCHES, short: int = SHORT) -> DataFrame:
    """``doc_id, body, node, keys``: hashes of the text as it is and of its words, and its sketches."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("body"), "text")
    return rows.mapInArrow(_sketcher(number, short), "doc_id long, body long, node long, keys array<long>")


def compare(left: np.ndarray, right: np.ndarray, similarity: float = SIMILARITY) -> tuple[float, int]:
    """Aligned similarity of two labelled sequences, and how many shingles they share.

    The alignment keeps to the band that ``similarity`` allows. It is left out,
    as 0, where the shared shingles are too few for it.
    """
    total = len(left) + len(right)
    _, at_left, at_right = np.intersect1d(left, right, assume_unique=True, return_indices=True)
    shared = len(at_left)
    if shared < similarity * (total - shared):
        return 0.0, shared
    band = int(total * (1 - similarity) / (1 + similarity)) + 1
    order = np.argsort(at_left)
    at_left, at_right = at_left[order], at_right[order]
    # Labelled shingles are distinct, so the best alignment is the longest ascending run of places.
    ends: list[int] = []
    for place in at_right[np.abs(at_left - at_right) <= band].tolist():
        spot = bisect_left(ends, place)
        ends[spot:spot + 1] = [place]
    return len(ends) / (total - len(ends)), shared


def _sequencer(batches):
    """``node, sequence`` of texts; rows whose text is not the wanted one are left out."""
    hashes = _Hashes()
    for batch in batches:
        nodes, sequences = [], []
        for wanted, text in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist()):
            shingles = labelled_shingles(text or "", hashes)
            if np.uint64(_text_hash(text or "", shingles)).astype(np.int64) == wanted:
                nodes.append(wanted)
                sequences.append(shingles.view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array(sequences, pa.list_(pa.int64()))], ["node", "sequence"])


def _verifier(similarity: float) -> Callable:
    def run(batches):
        for batch in batches:
            found = []
            for a, b in zip(batch.column("left_sequence"), batch.column("right_sequence")):
                a, b = (x.values.to_numpy().view(np.uint64) for x in (a, b))
                found.append(compare(a, b, similarity)[0])
            yield pa.RecordBatch.from_arrays(
                [batch.column("left"), batch.column("right"), pa.array(found, pa.float64())], ["left", "right", "aligned"])
    return run


def read_sequences(used: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """``node, sequence`` of the distinct ``node``s that are used; staged."""
    wanted = nodes.join(used.distinct(), "node", "left_semi").select("node", "rep", "rep_body")
    bodies = docs.select("doc_id", F.xxhash64("text").alias("body"), "text")
    # By id and text, as rows may share their id.
    same = F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("body") == F.col("rep_body"))
    texts = bodies.join(wanted, same).select("node", "text")
    return stage(texts.mapInArrow(_sequencer, "node long, sequence array<long>").dropDuplicates(["node"]))


def verify(pairs: DataFrame, read: DataFrame, similarity: float) -> DataFrame:
    """``left, right, aligned`` of distinct pairs of texts; staged."""
    left = read.select(F.col("node").alias("left"), F.col("sequence").alias("left_sequence"))
    right = read.select(F.col("node").alias("right"), F.col("sequence").alias("right_sequence"))
    rows = pairs.select("left", "right").distinct().join(left, "left").join(right, "right")
    rows = rows.select("left", "right", "left_sequence", "right_sequence")
    return stage(rows.mapInArrow(_verifier(similarity), "left long, right long, aligned double"))


def star(rows: DataFrame) -> DataFrame:
    """``bucket, node, hub`` of the buckets with several texts."""
    # Written first, so that joins with it are planned by its size, and split where a bucket is huge.
    sizes = stage(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1))
    shared = stage(rows.join(sizes, "bucket"))
    degrees = shared.groupBy("node").agg(F.sum("size").alias("degree"))
    ranked = shared.join(degrees, "node")
    hubs = stage(ranked.groupBy("bucket").agg(F.max_by("node", F.struct("degree", "node")).alias("hub")))
    return shared.select("bucket", "node").join(hubs, "bucket").where(F.col("node") != F.col("hub"))


def left_open(stars: DataFrame, read: DataFrame, labels: DataFrame, similarity: float) -> DataFrame:
    """``left, right`` pairs below one hub that may be alike although one of them failed against it.

    Of texts of n and m shingles that are alike, ``share * (n + m)`` are shared
    at least. What half of the hub's texts have is common. Either that many of
    both texts are common, which gives a range of m for each n, or they share
    some that are not. Pairs within a class are left out.
    """
    share = similarity / (1 + similarity)
    failed = (F.col("aligned") < similarity).alias("failed")
    members = stars.select(F.col("left").alias("hub"), F.col("right").alias("node"), failed)
    hubs = members.groupBy("hub").agg(F.count(F.lit(1)).alias("members"), F.max("failed").alias("any_failed"))
    hubs = hubs.where(F.col("any_failed") & (F.col("members") > 1)).select("hub", "members")
    held = members.join(hubs.select("hub"), "hub", "left_semi").join(read, "node")
    counted = held.select("hub", F.explode("sequence").alias("shingle")).groupBy("hub", "shingle").agg(
        F.count(F.lit(1)).alias("times"))
    placed = held.select("hub", "node", "failed", F.explode("sequence").alias("shingle")).join(counted, ["hub", "shingle"]).join(
        hubs, "hub")
    rare = F.array_sort(F.collect_list(F.when(F.col("times") * 2 < F.col("members"), F.struct("times", "shingle"))))
    own = placed.groupBy("hub", "node", "failed").agg(F.count(F.lit(1)).cast("int").alias("n"), rare.alias("rare"))
    own = own.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")).withColumn(
        "shared", F.col("n") - F.size("rare"))
    own = stage(own.withColumn("most", F.floor(F.col("shared") / share - F.col("n") + 1e-9)))
    differ = F.col("label") != F.col("o_label")

    other = own.select("hub", *[F.col(c).alias(f"o_{c}") for c in ("node", "n", "most", "label")])
    least, most = F.ceil(F.col("n") * similarity - 1e-9), F.least("most", F.floor(F.col("n") / similarity + 1e-9))
    ranges = own.where(F.col("failed")).select("hub", "node", "n", "label", least.alias("least"), most.alias("most"))
    ranges = ranges.where(F.col("least") <= F.col("most")).select(
        "hub", "node", "n", "label", F.explode(F.sequence("least", "most")).alias("o_n"))
    by_number = ranges.join(other, ["hub", "o_n"]).where(differ & (F.col("n") <= F.col("o_most")))

    # A text alike to this one shares at least similarity * n shingles with it, all but "shared" of them rare ones: so
    # one of the rarest of these is shared as well. What only one text has is of no use.
    needed = F.greatest(F.ceil(F.col("n") * similarity - F.col("shared") - 1e-9), F.lit(1))
    first = F.slice("rare", F.lit(1), F.greatest(F.size("rare") - needed + 1, F.lit(0)).cast("int"))
    rare = own.select("hub", "node", "n", "label", "failed", "shared", F.size("rare").alias("size"),
                      F.posexplode_outer(first).alias("place", "entry")).where(F.col("entry.times") > 1)
    rare = rare.select("hub", "node", "n", "label", "failed", "shared", F.col("entry.shingle").alias("shingle"),
                       (F.col("size") - F.col("place")).alias("left"))
    # Only shingles that could join two classes, one of them by a text that failed.
    useful = rare.groupBy("hub", "shingle").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.max("failed").alias("failed"))
    useful = useful.where(F.col("failed") & (F.col("low") != F.col("high"))).select("hub", "shingle")
    rare = stage(rare.join(useful, ["hub", "shingle"], "left_semi"))
    there = rare.select("hub", "shingle", *[F.col(c).alias(f"o_{c}") for c in ("node", "n", "label", "shared", "left")])
    # Where two texts meet first, all rare shingles that they share are from here on.
    enough = F.least("shared", "o_shared") + F.least("left", "o_left") >= (F.col("n") + F.col("o_n")) * share - 1e-9
    by_shingle = rare.where(F.col("failed")).join(there, ["hub", "shingle"]).where(differ & enough)
    pairs = by_number.select("node", "o_node").union(by_shingle.select("node", "o_node"))
    return pairs.select(F.least("node", "o_node").alias("left"), F.greatest("node", "o_node").alias("right"))


def class_labels(nodes: DataFrame, docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``node, label`` of the texts that are alike to some other."""
    rows = nodes.select("node", F.explode("keys").alias("bucket"))
    found, first, read = [], None, None
    for _ in range(ROUNDS):
        starred = stage(star(rows))
        if read is None:
            read = read_sequences(starred.select("node").union(starred.select("hub")), nodes, docs)
        compared = verify(starred.select(F.col("hub").alias("left"), F.col("node").alias("right")), read, similarity)
        first = first or compared
        found.append(compared.where(F.col("aligned") >= similarity).select("left", "right"))
        failed = compared.where(F.col("aligned") < similarity).select(F.col("left").alias("hub"), F.col("right").alias("node"))
        rows = starred.join(failed, ["hub", "node"]).select("node", "bucket")
    labels = components(reduce(DataFrame.union, found))
    checked = verify(left_open(first, read, labels, similarity), read, similarity)
    late = checked.where(F.col("aligned") >= similarity).select("left", "right")
    return labels if late.isEmpty() else components(reduce(DataFrame.union, [*found, late]))


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: the smallest node of each connected component of ``left, right`` edges.

    Labels travel along the edges and are looked up in each other until nothing
    changes; each round is written, so none has to be worked out again.
    """
    both = stage(edges.select("left", "right").union(edges.select("right", "left")).distinct().toDF("node", "other"))
    labels = stage(both.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("label")))
    while True:
        beside = both.join(labels.toDF("other", "near"), "other").groupBy("node").agg(F.min("near").alias("near"))
        lowered = labels.join(beside, "node").select("node", "label", F.least("label", "near").alias("low"))
        jumped = labels.toDF("low", "jump")
        after = stage(lowered.join(jumped, "low").select("node", "label", F.least("low", "jump").alias("next")))
        settled = after.where(F.col("next") != F.col("label")).isEmpty()
        labels = after.select("node", F.col("next").alias("label"))
        if settled:
            return labels


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, class_id`` of every document; near copies share the class id."""
    sketched = stage(sketch(docs))
    # The row that stands for a node: the smallest id, and of rows that share it the smallest hash.
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "body")
    nodes = stage(sketched.groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.min_by("body", order).alias("rep_body"), F.first("keys").alias("keys")))
    labels = class_labels(nodes, docs, similarity)
    named = nodes.select("node", "rep").join(labels, "node", "left").select(
        "node", "rep", F.coalesce("label", "node").alias("label"))
    smallest = named.groupBy("label").agg(F.min("rep").alias("class_id"))
    by_node = named.join(smallest, "label").select("node", "class_id")
    return sketched.select("doc_id", "node").join(by_node, "node").select("doc_id", "class_id")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each class, the one with the smallest id.

    Rows that share a ``doc_id`` stay or go together; rows without one stay.
    """
    own = classes(docs, similarity).where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_copy")).agg(
        F.bool_and(F.col("doc_id") != F.col("class_id")).alias("_goes"))
    gone = own.where(F.col("_goes")).select("_copy")
    return docs.join(gone, docs["doc_id"] == gone["_copy"], "left_anti")
