"""Incremental feed ingest: committed per batch of landed files, safe to repeat.

Two queries run one after the other. The first reads the bodies of new files
and writes their products, and a narrow row with the verdict on each fetch. The
second keeps a state for each page of a crawl of a store: its last fetch, and
whether that was good. A batch touches the state of its own pages only, and a
read takes which pages count from the state, not from old verdicts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wareloom import schemas
from wareloom.operators import contract, counters, keyed, sinks
from wareloom.plans.ingest import judge
from wareloom.session import stage
from wareloom.sources import feeds

# One row per product and one per page without any; rejected products stay in it.
FEED_LOG = T.StructType([
    T.StructField("crawl", T.LongType()),
    T.StructField("store", T.StringType()),
    T.StructField("page", T.LongType()),
    T.StructField("fetch_seq", T.LongType()),
    T.StructField("verdict", T.StringType()),
    T.StructField("pos", T.IntegerType()),
    *schemas.PRODUCTS.fields,
    T.StructField("reject_reason", T.StringType()),
])
VERDICTS = T.StructType([*FEED_LOG.fields[:4], T.StructField("bad", T.BooleanType())])

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _write_batch(table: str, checkpoint: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.append_batch(contract.conform(judge(feeds.read_pages(batch)), FEED_LOG), table, batch_id)
        written = sinks.read_batch(batch.sparkSession, table, FEED_LOG, batch_id)
        # Each fetch has one row without a product or with its first. A repeated batch writes its verdicts again, which
        # changes nothing in the state.
        fetches = written.where((F.coalesce("pos", F.lit(0)) == 0) & (F.col("page") >= 1))
        judged = fetches.withColumn("bad", F.col("verdict") != feeds.PAGE_OK)
        contract.conform(judged, VERDICTS).write.mode("append").parquet(f"{checkpoint}-verdicts")

    return write


def stream_feed(spark: SparkSession, landing: str, table: str, checkpoint: str, files_per_batch: int = 1000):
    """Work through all landed payload files not seen yet, then stop.

    Each batch reads its bodies once and appends their products under its own
    number, so a batch repeated after a failure replaces itself.
    """
    payloads = (
        spark.readStream.schema(schemas.FEED_PAYLOADS).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
    )
    return (
        payloads.writeStream.foreachBatch(_write_batch(table, checkpoint))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_stops(spark: SparkSession, checkpoint: str, files_per_batch: int = 10_000):
    """Bring the state of each page up to the verdicts written so far, then stop.

    Pages are spread over the tasks one by one, so a huge store is no larger to a task than many small ones.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    verdicts = spark.readStream.schema(VERDICTS).option("maxFilesPerTrigger", files_per_batch).parquet(f"{checkpoint}-verdicts")
    return (
        feeds.last_judged(verdicts).writeStream.format("noop").outputMode("update")
        .option("checkpointLocation", f"{checkpoint}-pages")
        .trigger(availableNow=True)
        .start()
    )


def run_stream(spark: SparkSession, landing: str, table: str, checkpoint: str, files_per_batch: int = 1000) -> None:
    """Take in all that has landed; then write which products were left out, and the counts of the counting pages.

    They go to ``table``, ``table-rejects`` and ``table-counts``; the latter two are of all batches so far.
    """
    stream_feed(spark, landing, table, checkpoint, files_per_batch).awaitTermination()
    stream_stops(spark, checkpoint).awaitTermination()
    products = _counting_products(spark, table, checkpoint)
    sinks.append_batch(feeds.rejected(products), f"{table}-rejects", 0)
    sinks.append_batch(counters.outcome_counts(products, "crawl", "store", "page"), f"{table}-counts", 0)


def _pages(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``crawl, store, page, fetch_seq, bad`` of the last fetch of each page, from the state."""
    state = spark.read.format("statestore").load(f"{checkpoint}-pages")
    # The parts of the two aggregates, in their order; the last is the number again.
    fetch_seq, bad, _ = state.schema["value"].dataType.names
    return state.select("key.crawl", "key.store", "key.page", F.col("value")[fetch_seq].alias("fetch_seq"), F.col("value")[bad].alias("bad"))


def last_fetches(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``crawl, store, page, fetch_seq`` of the last fetch of each page, from the state."""
    return _pages(spark, checkpoint).select(*feeds.FETCH)


def _counting(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The stops, written out, and the fetches that count, from the last fetches ``pages``."""
    stops = stage(feeds.store_stops(pages))
    return stops, feeds.before_stops(pages, stops).select(*feeds.FETCH)


def counting_pages(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``crawl, store, page, fetch_seq`` of the fetches that count, from the state."""
    return _counting(stage(_pages(spark, checkpoint)))[1]


def _without_others(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of the fetches ``wanted``.

    Only the fetches in ``rows``, one narrow row each, are joined with those
    wanted; what they have beyond them, mostly a few replaced fetches, is
    written out and left out of ``rows``, which no join has to shuffle then.
    """
    known = rows.where(F.col("store").isNotNull() & F.col("page").isNotNull())
    fetches = known.where(F.coalesce("pos", F.lit(0)) == 0).select(*feeds.FETCH)
    others = stage(fetches.join(wanted, feeds.FETCH, "left_anti"))
    return known.join(others, feeds.FETCH, "left_anti")


def _counting_products(spark: SparkSession, table: str, checkpoint: str) -> DataFrame:
    stops, counting = _counting(stage(_pages(spark, checkpoint)))
    rows = feeds.products_only(sinks.read_batches(spark, table, FEED_LOG))
    return _without_others(feeds.before_stops(rows, stops), counting)


def read_stream_table(spark: SparkSession, table: str, checkpoint: str) -> DataFrame:
    """Product table after all batches so far, however the files fell into batches."""
    return keyed.keep_last(feeds.accepted(_counting_products(spark, table, checkpoint))).select(*schemas.PRODUCTS.names)


def read_stream_rejects(spark: SparkSession, table: str, checkpoint: str) -> DataFrame:
    """Products of counting pages that were left out, with the reason."""
    return feeds.rejected(_counting_products(spark, table, checkpoint))


def compact_stream(spark: SparkSession, table: str, checkpoint: str, to: str) -> None:
    """Write what may still count to a new table, with which the stream goes on under the same ``checkpoint``.

    Products of fetches that a later fetch of their page has replaced are left
    out. Pages that do not count stay, as a fetch to come may close the gap before them.
    """
    rows = sinks.read_batches(spark, table, FEED_LOG)
    last = rows.agg(F.max("batch_seq")).first()[0]
    current = _without_others(rows.drop("batch_seq"), last_fetches(spark, checkpoint))
    sinks.append_batch(current, to, last or 0)
