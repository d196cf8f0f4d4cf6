"""Byte-level BPE encoding and decoding by overlapping chunks.

A text of more than ``chunk`` characters is cut into chunks that overlap. The
chunks are pre-tokenised in parallel. Two neighbours resynchronise at the first
pre-token boundary that both have inside their overlap; from there on the later
chunk is right. The text is cut at these boundaries, the pieces are encoded in
parallel and the ids put together in order. A chunk that never meets its
neighbour (a single pre-token longer than the overlap) is joined to the piece
before, and so are all later ones, so the ids are always those of the whole text.

Nulls and edge cases: a null text counts as empty; an empty text has no ids and
decodes to no bytes; rows are never merged, also where ``doc_id`` is null or
repeated; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, Window, functions as F

CHUNK = 1 << 16
OVERLAP = 1 << 10
#: Texts worked on at a time.
ROWS = 256
#: No pre-token is decided by more characters than this beyond its end.
MARGIN = 4


def read_ranks(path: str) -> bytes:
    """The rank file, to be sent along with the tasks; about a megabyte."""
    with open(path, "rb") as file:
        return file.read()


@lru_cache(maxsize=2)
def _encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    pairs = (line.split() for line in ranks.splitlines() if line)
    return tiktoken.Encoding(
        "ranks", pat_str=pattern, mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs},
        special_tokens={})


def _with_column(name: str, kind: pa.DataType, source: str, values: Callable, keep: bool = False) -> Callable:
    """A batch function that adds the column ``name``, or puts it in place of ``source``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, ROWS):
                batch = whole.slice(begin, ROWS)
                made = pa.array(values(batch.column(source)), kind)
                names = [n for n in batch.schema.names if keep or n != source]
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), made], [*names, name])
    return run


def _encoder(ranks: bytes, pattern: str) -> Callable:
    def ids(texts):
        encoding = _encoding(ranks, pattern)
        return [encoding.encode_to_numpy(text.as_py() or "").astype("<u4").tobytes() for text in texts]
    return _with_column("ids", pa.binary(), "text", ids)


def _decoder(ranks: bytes, pattern: str) -> Callable:
    def decoded(rows):
        encoding = _encoding(ranks, pattern)
        return [encoding.decode_bytes(memoryview(row.as_py() or b"").cast("I").tolist()) for row in rows]
    return _with_column("decoded", pa.binary(), "ids", decoded, keep=True)


def _cut(chunk: int, overlap: int) -> Callable:
    """Rows of whole texts to rows of overlapping chunks."""
    step = chunk - overlap

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                text = row["text"]
                starts = range(0, max(len(text) - overlap, 1), step)
                yield pa.RecordBatch.from_pylist([
                    {"doc_id": row["doc_id"], "key": row["key"], "no": no, "last": start == starts[-1],
                     "text": text[start:start + chunk]}
                    for no, start in enumerate(starts)], _CHUNKS)
    return run


_CHUNKS = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("no", pa.int64()), ("last", pa.bool_()),
                     ("text", pa.string())])


def boundaries(pattern: regex.Pattern, text: str, step: int, overlap: int, first: bool, last: bool):
    """Where a chunk may be cut inside its first and its last overlap, counted from the chunk's start.

    Only after a character that is not white space: how much white space a
    pre-token takes depends on what follows it.
    """
    ends = [0, *(match.end() for match in pattern.finditer(text))]
    ends = [end for end in ends if end == 0 or not text[end - 1].isspace()]
    head = [] if first else [end for end in ends if end <= overlap - MARGIN]
    tail = [] if last else [end for end in ends if step <= end <= step + overlap - MARGIN]
    return head, tail


def _pretokeniser(pattern: str, step: int, overlap: int) -> Callable:
    def run(batches):
        compiled = regex.compile(pattern)
        for batch in batches:
            rows = zip(*(batch.column(name).to_pylist() for name in ("text", "no", "last")))
            found = [boundaries(compiled, text, step, overlap, no == 0, last) for text, no, last in rows]
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([head for head, _ in found], kind), pa.array([tail for _, tail in found], kind)],
                [*batch.schema.names, "head", "tail"])
    return run


def pieces(long_texts: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """``doc_id, key, times, piece, text``: texts cut where the chunks resynchronise."""
    step = chunk - overlap
    rows = long_texts.select("doc_id", F.xxhash64("text").alias("key"), "text")
    chunks = (
        rows.mapInArrow(_cut(chunk, overlap), "doc_id long, key long, no long, last boolean, text string")
        # Spreads the chunks; equal texts under one id are worked on once.
        .groupBy("doc_id", "key", "no", "last").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("times"))
        .mapInArrow(_pretokeniser(pattern, step, overlap),
                    "doc_id long, key long, no long, last boolean, text string, times long, "
                    "head array<int>, tail array<int>")
    )
    by_text = Window.partitionBy("doc_id", "key").orderBy("no")
    before = F.transform(F.lag("tail").over(by_text), lambda end: end - F.lit(step))
    met = F.when(F.col("no") == 0, 0).otherwise(F.array_min(F.array_intersect("head", before)))
    synced = F.min(F.col("met").isNotNull()).over(by_text)
    start = F.when(F.col("synced"), F.col("met")).otherwise(0)
    after = F.when(F.col("last"), F.char_length("text")).otherwise(step + F.lead("start").over(by_text))
    piece = F.last(F.when(F.col("synced"), F.col("no")), ignorenulls=True).over(by_text)
    cut = (
        chunks.withColumn("met", met).withColumn("synced", synced).withColumn("start", start)
        .withColumn("end", after).withColumn("piece", piece)
        .select("doc_id", "key", "times", "piece", "no",
                F.substring("text", F.col("start") + 1, F.col("end") - F.col("start")).alias("text"))
    )
    parts = F.array_sort(F.collect_list(F.struct("no", "text")))
    return cut.groupBy("doc_id", "key", "times", "piece").agg(F.array_join(parts["text"], "").alias("text"))


def encode(docs: DataFrame, ranks: bytes, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, n_tokens, ids``: ids as little-endian unsigned 32-bit integers in a binary column."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    encoder = _encoder(ranks, pattern)
    is_long = F.char_length("text") > chunk
    short = texts.where(~is_long).mapInArrow(encoder, "doc_id long, ids binary")
    encoded = pieces(texts.where(is_long), pattern, chunk, overlap).repartition("doc_id", "key", "piece").mapInArrow(
        encoder, "doc_id long, key long, times long, piece long, ids binary")
    # Strings hold any bytes here; only they can be joined in one go.
    parts = F.array_sort(F.collect_list(F.struct("piece", F.col("ids").cast("string").alias("ids"))))
    long = (
        encoded.groupBy("doc_id", "key", "times").agg(F.array_join(parts["ids"], "").cast("binary").alias("ids"))
        .select("doc_id", "ids", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("copy"))
        .drop("copy")
    )
    return short.unionByName(long).select("doc_id", n_tokens(F.col("ids")).alias("n_tokens"), "ids")


def n_tokens(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")


def decode(encoded: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded``: the bytes of all ids one after the other."""
    rows = encoded.select("doc_id", "n_tokens", "ids")
    return rows.mapInArrow(_decoder(ranks, pattern), "doc_id long, n_tokens long, ids binary, decoded binary")


def digests(decoded: DataFrame, *keep: str) -> DataFrame:
    """``doc_id, n_tokens``, columns to keep, ``ids_sha256, decoded_sha256``."""
    return decoded.select("doc_id", "n_tokens", *keep, F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))
