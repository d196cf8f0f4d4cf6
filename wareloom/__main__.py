"""The runs as jobs: ``spark-submit ... -m wareloom`` or ``python -m wareloom``.

  feed    landed feed pages into the product table
  stream  the same, batch by batch, for files not seen before
  pages   captured web pages into the scraped product table
  select  both tables into the scored table and the three reports
  compact all batches of a table into one in buckets, or those of a stream into a new table
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from wareloom import schemas
from wareloom.operators import buckets, sinks
from wareloom.plans import ingest, selection
from wareloom.session import run_folder
from wareloom.sources import seeds
from wareloom.streaming import ingest as stream


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="wareloom", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    runs = parser.add_subparsers(dest="run", required=True)

    feed = runs.add_parser("feed")
    feed.add_argument("--payloads", required=True)
    feed.add_argument("--table", required=True)
    feed.add_argument("--batch", type=int, required=True)
    feed.add_argument("--stores", help="parquet with seed_no, base_url, store; the default stores if absent")

    streamed = runs.add_parser("stream")
    streamed.add_argument("--landing", required=True)
    streamed.add_argument("--table", required=True)
    streamed.add_argument("--progress", required=True)

    pages = runs.add_parser("pages")
    pages.add_argument("--pages", required=True)
    pages.add_argument("--seeds", help="parquet with seed_no, category, url; the default categories if absent")
    pages.add_argument("--table", required=True)
    pages.add_argument("--batch", type=int, required=True)

    pages.add_argument("--max-pages", type=int, help="cut longer listings; by default they are walked to their end")

    compact = runs.add_parser("compact")
    compact.add_argument("--kind", choices=["products", "scraped", "scored", "stream"], required=True)
    compact.add_argument("--progress", help="of the stream")
    compact.add_argument("--table", required=True)
    compact.add_argument("--to", help="new table of the stream")
    compact.add_argument("--buckets", type=int, default=buckets.BUCKETS)

    select = runs.add_parser("select")
    select.add_argument("--products")
    select.add_argument("--scraped")
    select.add_argument("--out", required=True)
    select.add_argument("--batch", type=int, required=True)
    select.add_argument("--top", type=int, default=schemas.TOP_K)
    select.add_argument("--per-store", type=int, default=schemas.FLAGSHIP_PER_STORE)
    return parser


def main(argv=None) -> None:
    args = arguments().parse_args(argv)
    spark = SparkSession.builder.appName(f"wareloom {args.run}").getOrCreate()
    with run_folder(spark):
        run(spark, args)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.run == "feed":
        payloads = spark.read.schema(schemas.FEED_PAYLOADS).parquet(args.payloads)
        stores = spark.read.parquet(args.stores) if args.stores else seeds.store_seeds(spark)
        ingest.run_feed(payloads, args.table, args.batch, stores)
    elif args.run == "stream":
        stream.run_stream(spark, args.landing, args.table, args.progress)
    elif args.run == "pages":
        captured = spark.read.schema(schemas.CAPTURED_PAGES).parquet(args.pages)
        start = spark.read.schema(schemas.CATEGORY_SEEDS).parquet(args.seeds) if args.seeds else seeds.category_seeds(spark)
        ingest.run_pages(captured, start, args.table, args.batch, args.max_pages)
    elif args.run == "compact" and args.kind == "stream":
        if not args.progress or not args.to:
            raise SystemExit("a stream needs --progress and --to")
        stream.compact_stream(spark, args.table, args.progress, args.to)
    elif args.run == "compact":
        schema = {"products": schemas.stored(schemas.PRODUCTS), "scraped": schemas.stored(schemas.SCRAPED_PRODUCTS),
                  "scored": selection.SCORED_LOG}[args.kind]
        order = schemas.ORDER_COLUMNS if args.kind == "scored" else ("ordinal",)
        sinks.compact(spark, args.table, schema, order=order, count=args.buckets)
    else:
        if not args.products and not args.scraped:
            raise SystemExit("select needs --products, --scraped or both")
        products = scraped = None
        if args.products:
            products = ingest.read_products(spark, args.products)
        if args.scraped:
            scraped = ingest.read_scraped(spark, args.scraped)
        selection.run_selection(products, scraped, args.out, args.batch, args.top, args.per_store)


if __name__ == "__main__":
    main()
