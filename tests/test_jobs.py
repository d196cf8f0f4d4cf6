"""The runs from the command line, one after the other."""

import json
import os

from pyspark.sql import functions as F, types as T

from wareloom import schemas
from wareloom.__main__ import main
from wareloom.operators import buckets, sinks
from wareloom.plans import ingest, selection
from wareloom.session import run_folder, stage
from wareloom.sources import pages


def test_feed_pages_and_select(spark, tmp_path):
    path = {n: str(tmp_path / n) for n in ("payloads", "products", "pages", "scraped", "out", "seeds")}

    def land(seq, *items):
        body = json.dumps({"products": [
            {"title": t, "handle": h, "body_html": "<p>d</p>", "variants": [{"price": p, "available": True}]}
            for t, h, p in items]})
        rows = [(seq, "a", "https://www.a.com", 1, 200, body, seq)]
        spark.createDataFrame(rows, schemas.FEED_PAYLOADS).write.mode("overwrite").parquet(path["payloads"])

    for batch, items in enumerate([[("One", "1", "10"), ("Two", "2", "20")], [("One again", "1", "12")]]):
        land(batch, *items)
        main(["feed", "--payloads", path["payloads"], "--table", path["products"], "--batch", str(batch)])

    listing = '<div class="product-small box"><a href="/p">x</a></div>'
    page = '<h1 class="product_title entry-title">Pin</h1><p class="price"><span class="woocommerce-Price-amount amount">$30</span></p>'
    spark.createDataFrame([("https://b.com/c", listing, 0), ("https://b.com/p", page, 1)], schemas.CAPTURED_PAGES).write.parquet(path["pages"])
    spark.createDataFrame([(0, "C", "https://b.com/c")], schemas.CATEGORY_SEEDS).write.parquet(path["seeds"])
    main(["pages", "--pages", path["pages"], "--seeds", path["seeds"], "--table", path["scraped"], "--batch", "0"])

    main(["select", "--products", path["products"], "--scraped", path["scraped"], "--out", path["out"], "--batch", "0"])
    saved = {r.title: (float(r.price), r.source_store_name) for r in selection.read_scored(spark, path["out"]).collect()}
    assert saved == {"One again": (12.0, "a"), "Two": (20.0, "a"), "Pin": (30.0, schemas.SCRAPED_STORE)}
    ranks = sinks.read_refreshed(spark, f"{path['out']}/store_rankings", schemas.STORE_RANKINGS).collect()
    assert {r.source_store_name: r.source_platform for r in ranks} == {
        "a": schemas.STRUCTURED_PLATFORM, schemas.SCRAPED_STORE: schemas.SCRAPED_PLATFORM}
    counts = sinks.read_batches(spark, f"{path['products']}-counts", T.StructType.fromDDL("accepted long, rejected long"))
    assert sorted((r.batch_seq, r.accepted, r.rejected) for r in counts.collect()) == [(0, 2, 0), (1, 1, 0)]
    assert sinks.read_batches(spark, f"{path['products']}-rejects", T.StructType.fromDDL("reject_reason string")).count() == 0
    stamp = T.StructType.fromDDL("scraped_at timestamp")
    assert all(r.scraped_at for r in sinks.read_batches(spark, path["products"], stamp).collect())

    before = ingest.read_products(spark, path["products"]).collect()
    main(["compact", "--kind", "products", "--table", path["products"], "--buckets", "4"])
    after = ingest.read_products(spark, path["products"])
    assert sorted(map(str, before)) == sorted(map(str, after.collect())) and len(before) == 2
    assert all(row.scraped_at for row in before)
    land(2, ("Two later", "2", "21"))
    main(["feed", "--payloads", path["payloads"], "--table", path["products"], "--batch", "2"])
    main(["compact", "--kind", "products", "--table", path["products"]])
    titles = {r.title: r.scraped_at for r in ingest.read_products(spark, path["products"]).collect()}
    assert titles["One again"] == next(r.scraped_at for r in before if r.title == "One again") < titles["Two later"]


def test_stored_tables_stay_in_their_buckets(spark, tmp_path):
    """The fold and the look-up of links shuffle the new side only."""
    stored = spark.range(1000).select(F.concat(F.lit("u"), "id").alias("product_url"), F.col("id").alias("ordinal"))
    buckets.save(stored, str(tmp_path / "t"), "product_url", 6)
    base = buckets.load(spark, str(tmp_path / "t"), stored.schema, "product_url", 6)
    recent = spark.createDataFrame([("u7", 5000), ("u7", 4000), ("new", 1)], stored.schema)
    links = spark.createDataFrame([("u1",), ("gone",)], "link string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for plan in (buckets.fold(base, recent, buckets=6), pages.missing_pages(links, base.select(F.col("product_url").alias("url")))):
            lines = plan._jdf.queryExecution().executedPlan().toString().splitlines()
            (scan,) = [n for n, line in enumerate(lines) if "FileScan" in line]
            assert "Bucketed: true" in lines[scan]
            # Nothing between the scan and its join deals rows out.
            depth, above = lines[scan].index("FileScan"), []
            for line in reversed(lines[:scan]):
                if len(line) - len(line.lstrip(" :+-")) < depth:
                    depth = len(line) - len(line.lstrip(" :+-"))
                    above.append(line)
            assert "SortMergeJoin" in "".join(above) and "Exchange" not in "".join(above), lines
        folded = {r.product_url: r.ordinal for r in buckets.fold(base, recent, buckets=6).collect()}
        assert len(folded) == 1001 and folded["u7"] == 5000 and folded["new"] == 1
        assert [r.link for r in pages.missing_pages(links, base.select(F.col("product_url").alias("url"))).collect()] == ["gone"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_run_leaves_nothing_staged(spark):
    with run_folder(spark) as folder:
        kept = stage(spark.range(5))
        assert kept.count() == 5 and os.path.exists(folder)
    assert not os.path.exists(folder)
