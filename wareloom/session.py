"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Rows of a large table that one task takes: wide ones fill some 100 MB when they are sorted.
ROWS_A_TASK = 250_000
#: Compressed bytes that one task takes from a shuffle or from files; Spark's own 64 and 128 MB unfold to 1 GB in a sort.
BYTES_A_TASK = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
    "spark.sql.files.maxPartitionBytes": 32 << 20,
}

#: Folders of the runs that are under way, the innermost last.
_RUNS: list[str] = []


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings the feed operators rely on; they set them themselves.

    JSON objects with a repeated key keep the last value instead of failing
    the whole page.
    """
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def size_shuffles(spark: SparkSession, rows: int) -> int:
    """Tasks for ``rows`` rows; has the session's shuffles make as many, so that tasks stay small as tables grow.

    Settings are only ever changed to more and smaller tasks, from the second
    task on, and adaptive execution puts together what turns out small.
    """
    tasks = -(-rows // ROWS_A_TASK)
    if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
    for setting, most in BYTES_A_TASK.items():
        if tasks > 1 and _bytes(spark, spark.conf.get(setting)) > most:
            spark.conf.set(setting, most)
    return tasks


def _bytes(spark: SparkSession, size: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def _root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; without one, a place beside the session's tables."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root.rstrip("/") if root else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/wareloom-work"


def work_folder(spark: SparkSession) -> str:
    """A fresh sub-folder of the run under way, or of the shared folder."""
    return f"{_RUNS[-1] if _RUNS else _root(spark)}/wareloom-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for all that a run stages, removed when the run ends."""
    folder = work_folder(spark)
    _RUNS.append(folder)
    try:
        yield folder
    finally:
        _RUNS.remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts lineage without losing column pruning or pushdown, and survives the
    loss of any executor because the files sit in the shared folder.
    """
    spark = df.sparkSession
    path = f"{folder or work_folder(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
