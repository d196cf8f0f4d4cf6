"""WARC archives with a two-level capture index.

Records are written as gzip members into archive files, a response for each
payload and revisits for its repeats. The index sorts the captures by their
reversed-host URL key and page into shards. A shard is a file of compressed
blocks of lines, followed by a sparse directory with the first key of each
block; the shards' first and last keys are a small table. A lookup bisects the
shards, then the directory, reads the block it points to, and then only the
records it asks for, by byte range.

Files are written and read through ``pyarrow.fs`` under one shared folder, so
that folder may be on any store pyarrow knows. Names hold a random part: a task
that runs twice leaves an unused file, never a broken one.

Nulls and edge cases: a null payload is empty, a null URL has the key ``)``; a
null ``page_id`` is kept and never referred to; of rows with the same payload
and the same smallest ``page_id`` all are responses; payload text may hold
anything, record ends are found by length; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wareloom.session import stage, work_folder

#: Bytes after which an archive file is closed and a new one begun.
ARCHIVE_BYTES = 64 << 20
#: Captures in a compressed block of the index.
BLOCK = 500

_CAPTURE = "key string, page_id long, archive string, offset long, length long"
_SHARD = "shard string, first_key string, last_key string, directory long, bytes long"


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    """The store and the path of a folder given as a path or a URI."""
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))


def url_key(url: Column) -> Column:
    """``http://www.a.org/p?q`` becomes ``org,a,www)/p?q``: hosts sort by their suffix."""
    plain = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(plain, r"^(?s:.*?)://([^/?#]*)", 1)
    rest = F.when(plain.contains("://"), F.regexp_extract(plain, r"^(?s:.*?)://[^/?#]*((?s:.*))$", 1)).otherwise(plain)
    return F.concat(F.array_join(F.reverse(F.split(F.lower(host), r"\.")), ","), F.lit(")"), rest)


def classify(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, key, payload, digest, payload_bytes, refers_to``; the payload of revisits is null.

    A payload's rows are joined with one row per payload, so a payload that a
    third of all pages share can be split.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", url_key(F.col("url")).alias("key"),
                        payload.alias("payload"), F.sha1(payload).alias("digest"),
                        F.length(payload).cast("long").alias("payload_bytes"))
    firsts = (
        pages.select(F.sha1(payload).alias("digest"), "page_id").groupBy("digest")
        .agg(F.min("page_id").cast("long").alias("first"))
    )
    joined = rows.join(firsts, "digest", "left")
    later = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    repeat = later & (F.col("payload_bytes") >= min_bytes)
    return joined.select(
        "page_id", "url", "key", F.when(~repeat, F.col("payload")).alias("payload"), "digest", "payload_bytes",
        F.when(repeat, F.col("first")).alias("refers_to"))


def _identifier(page) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def _page(identifier: str):
    number = identifier.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record(page_id, url, payload, digest, payload_bytes, refers_to) -> bytes:
    """One record as a gzip member. Of a revisit only the HTTP head is kept."""
    revisit = refers_to is not None
    base32 = base64.b32encode(bytes.fromhex(digest)).decode()
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_identifier(page_id)}",
        # A line break would end the header.
        f"WARC-Target-URI: {(url or '').replace(chr(13), '%0D').replace(chr(10), '%0A')}",
        f"WARC-Payload-Digest: sha1:{base32}", "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Refers-To: {_identifier(refers_to)}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return gzip.compress("\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n", 6, mtime=0)


def parse(member: bytes) -> dict:
    """The fields of a record; the payload's digest is worked out again where there is a payload."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    announced = int(http.decode().rpartition("Content-Length: ")[2])
    stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    digest = stated if revisit else base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if not revisit and (digest != stated or len(payload) != announced):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return {"page_id": _page(fields["WARC-Record-ID"]), "payload_bytes": announced, "payload_digest": digest,
            "record_type": fields["WARC-Type"], "payload": None if revisit else payload,
            "refers_to": _page(fields["WARC-Refers-To"]) if revisit else None}


def _archive_writer(folder: str, limit: int) -> Callable:
    def run(batches):
        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        file, name, at = None, "", 0
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                key = row.pop("key")
                member = record(**row)
                if file is None or at >= limit:
                    if file is not None:
                        file.close()
                    name, at = f"{root}/{uuid.uuid4().hex}.warc.gz", 0
                    file = store.open_output_stream(name, compression=None)
                file.write(member)
                made.append({"key": key, "page_id": row["page_id"], "archive": name, "offset": at, "length": len(member)})
                at += len(member)
            yield pa.RecordBatch.from_pylist(made, _CAPTURES)
        if file is not None:
            file.close()
    return run


_CAPTURES = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("archive", pa.string()),
                       ("offset", pa.int64()), ("length", pa.int64())])
_SHARDS = pa.schema([("shard", pa.string()), ("first_key", pa.string()), ("last_key", pa.string()),
                     ("directory", pa.int64()), ("bytes", pa.int64())])


def write_archives(records: DataFrame, folder: str, limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all records; gives ``key, page_id, archive, offset, length``."""
    return stage(records.select("page_id", "url", "key", "payload", "digest", "payload_bytes", "refers_to").mapInArrow(
        _archive_writer(f"{folder}/archives", limit), _CAPTURE))


def _shard_writer(folder: str, size: int) -> Callable:
    def run(batches):
        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        name, directory, waiting, at = f"{root}/{uuid.uuid4().hex}.idx", [], [], 0
        file, last = None, None

        def flush():
            nonlocal at
            block = zlib.compress(json.dumps(waiting).encode())
            file.write(block)
            directory.append([waiting[0][0], at, len(block)])
            at += len(block)
            waiting.clear()

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                file = file or store.open_output_stream(name, compression=None)
                waiting.append(row)
                last = row[0]
                if len(waiting) == size:
                    flush()
        if file is None:
            return
        if waiting:
            flush()
        tail = zlib.compress(json.dumps(directory).encode())
        file.write(tail)
        file.close()
        yield pa.RecordBatch.from_pylist([{
            "shard": name, "first_key": directory[0][0], "last_key": last, "directory": at, "bytes": at + len(tail)}], _SHARDS)
    return run


def build_index(captures: DataFrame, folder: str, block: int = BLOCK) -> DataFrame:
    """Write the sorted shards; gives one row per shard.

    Ranges are over key and page, so one URL captured very often is spread too.
    """
    ordered = captures.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
    return stage(ordered.mapInArrow(_shard_writer(f"{folder}/index", block), _SHARD))


def find_in_shard(file, shard: dict, keys: list[str]):
    """The shard's captures of the sorted ``keys``, block by block, by bisecting its directory."""
    directory = json.loads(zlib.decompress(file.read_at(shard["bytes"] - shard["directory"], shard["directory"])))
    firsts = [entry[0] for entry in directory]
    current = None
    for key in keys:
        # Captures of a key may begin in the block before the first one that starts with it.
        for number in range(max(bisect_left(firsts, key) - 1, 0), bisect_right(firsts, key)):
            if number != current:
                _, at, length = directory[number]
                lines = json.loads(zlib.decompress(file.read_at(length, at)))
                current, starts = number, [line[0] for line in lines]
            found = lines[bisect_left(starts, key):bisect_right(starts, key)]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, field.type) for column, field in zip(zip(*found), _CAPTURES)], schema=_CAPTURES)


def _router(shards: list[dict]) -> Callable:
    """``number, key`` for each shard that may hold a key."""
    def run(batches):
        lasts = [shard["last_key"] for shard in shards]
        for batch in batches:
            made = []
            for key in batch.column(0).to_pylist():
                number = bisect_left(lasts, key)
                while number < len(shards) and shards[number]["first_key"] <= key:
                    made.append({"number": number, "key": key})
                    number += 1
            yield pa.RecordBatch.from_pylist(made, pa.schema([("number", pa.int64()), ("key", pa.string())]))
    return run


def _finder(shards: list[dict], folder: str) -> Callable:
    def run(batches):
        store, _ = _open(folder)
        for batch in batches:
            numbers, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for number, own in groupby(zip(numbers, keys), itemgetter(0)):
                with store.open_input_file(shards[number]["shard"]) as file:
                    yield from find_in_shard(file, shards[number], [key for _, key in own])
    return run


def lookup(shards: DataFrame, keys: DataFrame, folder: str) -> DataFrame:
    """All captures of the distinct URL ``key``s, by binary search in the index.

    The table of shards goes to the tasks; it has one row per task that wrote
    the index, however many captures there are. Keys are dealt out by shard, so
    a task opens few of them, and a key that fills many shards is read by many.
    """
    listed = sorted((row.asDict() for row in shards.collect()), key=lambda s: (s["first_key"], s["last_key"]))
    routed = keys.select("key").distinct().mapInArrow(_router(listed), "number long, key string")
    dealt = routed.repartitionByRange("number", "key").sortWithinPartitions("number", "key")
    return dealt.mapInArrow(_finder(listed, folder), _CAPTURE)


def _reader(folder: str) -> Callable:
    def run(batches):
        store, _ = _open(folder)
        name, file = None, None
        for batch in batches:
            made = []
            for archive, offset, length in zip(*(batch.column(n).to_pylist() for n in ("archive", "offset", "length"))):
                if archive != name:
                    if file is not None:
                        file.close()
                    name, file = archive, store.open_input_file(archive)
                fields = parse(file.read_at(length, offset))
                del fields["payload"]
                made.append(fields)
            yield pa.RecordBatch.from_pylist(made, _RECORDS)
        if file is not None:
            file.close()
    return run


_RECORDS = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                      ("record_type", pa.string()), ("refers_to", pa.int64())])


def read_records(captures: DataFrame, folder: str) -> DataFrame:
    """The records of ``captures``, read by byte range in the order they lie in the archives."""
    placed = captures.repartitionByRange("archive", "offset").sortWithinPartitions("archive", "offset")
    return placed.mapInArrow(
        _reader(folder), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive(spark: SparkSession, pages: DataFrame, folder: str | None = None,
            min_bytes: int = 0) -> tuple[str, DataFrame]:
    """Write the archives and the index; gives their folder and the table of shards."""
    folder = folder or work_folder(spark)
    captures = write_archives(classify(pages, min_bytes), folder)
    return folder, build_index(captures, folder)
