"""Tables kept as plain files.

A *refreshed* table is replaced as a whole: each refresh writes a new version
next to the old one, and a version counts once its marker exists. Nothing is
overwritten while it may still be read, and a job lost half-way leaves the
last good version in place.

A *keyed* table takes upserts: each batch is appended under its own number,
and reading folds the batches by key. Writing costs as much as the batch, not
as the table. A batch counts once its marker exists, and a repeated batch takes
the place of the earlier one when it is complete, so a lost job loses nothing.
From time to time all batches are folded into a table in Spark's buckets, which
later reads leave where it lies.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wareloom.operators import buckets
from wareloom.operators.keyed import folded_key, keep_last, merge_written

MARKER = "_PUBLISHED"
#: Lies in a batch that holds no key twice.
UNIQUE = "_UNIQUE"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _published_versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    fs, root = _file_system(spark, path)
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        numbered = re.fullmatch(r"version=(\d+)-\w+", name)
        if numbered and fs.exists(_file_system(spark, f"{path}/{name}/{MARKER}")[1]):
            found.append((int(numbered.group(1)), name))
    return sorted(found)


def refresh(df: DataFrame, path: str) -> bool:
    """Replace the table at ``path``. An empty frame leaves the old rows and gives False.

    Emptiness is looked up in the written files, so the plan runs once.
    """
    spark = df.sparkSession
    versions = _published_versions(spark, path)
    number = versions[-1][0] + 1 if versions else 1
    folder = f"{path}/version={number}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    if spark.read.schema(df.schema).parquet(folder).isEmpty():
        return False
    fs, marker = _file_system(spark, f"{folder}/{MARKER}")
    fs.create(marker, False).close()
    return True


def read_refreshed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    versions = _published_versions(spark, path)
    if not versions:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{versions[-1][1]}")


def _batch_attempts(spark: SparkSession, path: str, batch_id: int) -> list[tuple[int, str, bool]]:
    """``(attempt, folder, whether published)`` of one batch; looks at no other."""
    folder = f"{path}/batch_seq={batch_id}"
    fs, root = _file_system(spark, folder)
    found = []
    for status in fs.listStatus(root) if fs.exists(root) else []:
        name = status.getPath().getName()
        attempt = re.fullmatch(r"attempt=(\d+)-\w+", name)
        if attempt:
            published = fs.exists(_file_system(spark, f"{folder}/{name}/{MARKER}")[1])
            found.append((int(attempt.group(1)), name, published))
    return found


def _attempts(spark: SparkSession, path: str) -> dict[int, list[tuple[int, str, bool]]]:
    """The attempts of each batch, by batch number."""
    fs, root = _file_system(spark, path)
    names = [status.getPath().getName() for status in (fs.listStatus(root) if fs.exists(root) else [])]
    batches = [int(name.removeprefix("batch_seq=")) for name in names if re.fullmatch(r"batch_seq=\d+", name)]
    return {batch: _batch_attempts(spark, path, batch) for batch in batches}


def append_batch(df: DataFrame, path: str, batch_id: int, unique: bool = False) -> None:
    """Write one batch of upserts; writing the same batch again replaces it.

    ``unique`` says that no key comes twice in ``df``, so that a table of this batch alone is read as it lies.
    """
    spark = df.sparkSession
    earlier = _batch_attempts(spark, path, batch_id)
    number = max((attempt for attempt, _, _ in earlier), default=0) + 1
    folder = f"{path}/batch_seq={batch_id}/attempt={number}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    for name in [UNIQUE, MARKER] if unique else [MARKER]:
        fs, marker = _file_system(spark, f"{folder}/{name}")
        fs.create(marker, False).close()


def _last_published(attempts: list[tuple[int, str, bool]]) -> str | None:
    return max(((attempt, name) for attempt, name, published in attempts if published), default=(0, None))[1]


def _read_folders(spark: SparkSession, path: str, schema: T.StructType, folders: list[str]) -> DataFrame:
    with_batch = T.StructType([*schema.fields, T.StructField("batch_seq", T.LongType())])
    if not folders:
        return spark.createDataFrame([], with_batch)
    return spark.read.schema(with_batch).option("basePath", path).parquet(*folders).select(*with_batch.names)


def _batch_folders(spark: SparkSession, path: str, after: int = -1) -> list[str]:
    last = {batch: _last_published(attempts) for batch, attempts in _attempts(spark, path).items() if batch > after}
    return [f"{path}/batch_seq={batch}/{name}" for batch, name in last.items() if name]


def read_batches(spark: SparkSession, path: str, schema: T.StructType, after: int = -1) -> DataFrame:
    """All rows of the last published attempt of each batch with a number above ``after``, with ``batch_seq``."""
    return _read_folders(spark, path, schema, _batch_folders(spark, path, after))


def read_batch(spark: SparkSession, path: str, schema: T.StructType, batch_id: int) -> DataFrame:
    """All rows of the last published attempt of one batch, with ``batch_seq``; costs the same however many others there are."""
    name = _last_published(_batch_attempts(spark, path, batch_id))
    return _read_folders(spark, path, schema, [f"{path}/batch_seq={batch_id}/{name}"] if name else [])


def _stored(spark: SparkSession, path: str) -> tuple[int, str, int] | None:
    """Last batch, folder and number of buckets of the table that stands for all batches up to that one."""
    fs, root = _file_system(spark, path)
    found = []
    for status in fs.listStatus(root) if fs.exists(root) else []:
        name = status.getPath().getName()
        numbers = re.fullmatch(r"stored=(\d+)-(\d+)-\w+", name)
        if numbers and fs.exists(_file_system(spark, f"{path}/{name}/{MARKER}")[1]):
            found.append((int(numbers.group(1)), f"{path}/{name}", int(numbers.group(2))))
    return max(found, default=None)


def read_keyed(spark: SparkSession, path: str, schema: T.StructType, key: str = "product_url",
               order=("ordinal",), folded: bool = False) -> DataFrame:
    """Current state: the last write of each key, or of each folded key under the text written first.

    What is stored in buckets is not shuffled; later batches are, but for a single one without repeated keys.
    """
    stored = _stored(spark, path)
    folders = _batch_folders(spark, path, -1 if stored is None else stored[0])
    recent = _read_folders(spark, path, schema, folders)
    if stored is None and not folded and len(folders) == 1:
        fs, marker = _file_system(spark, f"{folders[0]}/{UNIQUE}")
        if fs.exists(marker):
            return recent.drop("batch_seq")
    if stored is None:
        rows = recent
    else:
        last, folder, count = stored
        base = buckets.load(spark, folder, schema, key, count)
        if not folded:
            return buckets.fold(base, recent, key, ["batch_seq", *order], count)
        rows = base.withColumn("batch_seq", F.lit(last).cast("long")).unionByName(recent)
    if folded:
        return merge_written(rows, key, ["batch_seq", *order], folded_key(key)).drop("batch_seq")
    return keep_last(rows, key, ["batch_seq", *order]).drop("batch_seq")


def compact(spark: SparkSession, path: str, schema: T.StructType, key: str = "product_url", order=("ordinal",),
            count: int = buckets.BUCKETS) -> None:
    """Fold all batches so far into one table in buckets; batches with higher numbers go on from it."""
    stored = _stored(spark, path)
    done = max((batch for batch, attempts in _attempts(spark, path).items() if any(a[2] for a in attempts)), default=-1)
    if done < 0 or (stored is not None and stored[0] >= done):
        return
    folder = f"{path}/stored={done}-{count}-{uuid.uuid4().hex}"
    buckets.save(read_keyed(spark, path, schema, key, order), folder, key, count)
    fs, marker = _file_system(spark, f"{folder}/{MARKER}")
    fs.create(marker, False).close()
