"""The test tables seen as catalogue inputs.

Each function reads whole tables and only rearranges them: every row of the
source takes part, and the amount of derived data grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wareloom.session import size_shuffles

SERIES_SIZE = 400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame, key: str) -> DataFrame:
    """The rows dealt out anew: the files come as one split each, and much is made of each row.

    Of a large table, each task gets the same number of rows, however many there are.
    """
    tasks, usual = size_shuffles(scan.sparkSession, scan.count()), scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(tasks, key) if tasks > usual else scan.repartition(key)


def _price_text(column: str):
    return F.concat(F.lit("$"), F.format_number(column, 2))


def structured_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` with its part and supplier as a structured product table.

    Rows repeat URLs; some have no price, some no URL.
    """
    lines = spread(table(spark, sf_dir, "lineitem"), "l_orderkey")
    parts = table(spark, sf_dir, "part")
    suppliers = table(spark, sf_dir, "supplier")
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(
        suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    url = F.concat(F.lit("https://s"), "l_suppkey", F.lit(".example.com/products/"), "l_partkey")
    days = F.unix_date(F.to_date("l_shipdate")).cast("bigint")
    return joined.select(
        F.when(F.col("l_quantity") != 1, url).alias("product_url"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("vendor"),
        F.when(F.col("l_linenumber") != 7, F.col("l_extendedprice")).alias("price"),
        F.when(F.col("l_linestatus") == "O", "Available").otherwise("Out of Stock").alias("availability"),
        F.concat(F.lit("<p> "), "p_type", F.lit(" <b>"), "p_size", F.lit("</b></p>")).alias("description"),
        F.col("p_type").alias("category"),
        F.col("s_name").alias("store_name"),
        ((F.shiftleft(days, 40) + F.col("l_orderkey")) * 8 + F.col("l_linenumber")).alias("ordinal"),
    )


def scraped_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as a scraped product table, with URLs that meet the structured ones."""
    return spread(table(spark, sf_dir, "orders"), "o_orderkey").select(
        F.concat(F.lit("https://s"), F.expr("o_custkey div 10"), F.lit(".example.com/products/"),
                 F.expr("o_orderkey div 4")).alias("product_url"),
        F.when((F.col("o_orderpriority") != "4-NOT SPECIFIED") | (F.col("o_orderstatus") != "F"),
               F.concat(F.lit("Order "), "o_orderkey")).alias("title"),
        F.when(F.col("o_orderstatus") == "P", "N/A").otherwise(_price_text("o_totalprice")).alias("price"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")).alias("tag"),
        F.concat(F.lit("SKU-"), "o_orderkey").alias("sku"),
        F.col("o_orderpriority").alias("category"),
        F.col("o_orderkey").alias("ordinal"),
    )


def feed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed pages: one store per brand, one page per hundred order keys.

    Products come with missing keys, explicit nulls, empty variants and bad
    prices. In the stores below 'Brand#2' a page of large quantities only
    answers with an error and a page of small ones is cut off.
    """
    page = F.expr("l_orderkey div 100 + 1")
    # Rows are shuffled to their page while they are still narrow.
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    ).withColumn("page", page).repartition("p_brand", "page")
    line, flag = F.col("l_linenumber"), F.col("l_returnflag")
    plain = F.format_string("%.2f", F.col("l_extendedprice"))
    price = (
        F.when((line == 4) & (F.col("l_linestatus") == "F") & (flag == "N"), "12d")
        .when((line == 2) & (flag == "R"), "")
        .when(line == 1, F.concat(F.lit(" "), plain))
        .otherwise(plain)
    )
    variant = F.struct(price.alias("price"), (F.col("l_linestatus") == "O").alias("available"))
    no_variants = (line == 1) & (flag == "R")
    product = F.to_json(F.struct(
        F.when((line != 7) & ~((line == 6) & (flag == "A")), F.col("p_name")).alias("title"),
        F.when(line != 5, F.col("p_brand")).alias("vendor"),
        F.concat(F.lit("<p>"), "p_type", F.lit("</p>")).alias("body_html"),
        F.col("p_type").alias("product_type"),
        F.when(F.col("l_quantity") == 1, "").otherwise(F.concat_ws("-", "l_partkey", "l_suppkey")).alias("handle"),
        F.when(~no_variants, F.array(variant)).alias("variants"),
    ))
    rest = F.substr(product, F.lit(2))
    with_nulls = (
        F.when((line == 6) & (flag == "A"), F.concat(F.lit('{"title":null,'), rest))
        .when(line == 5, F.concat(F.lit('{"vendor":null,'), rest))
        .otherwise(product)
    )
    store_no = F.substring("p_brand", 7, 10).cast("int")
    # Going through a one-element array has the products made before the rows are gathered, in generated code.
    lines = lines.select("p_brand", "page", "l_quantity", F.inline(F.array(F.struct(F.struct(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", with_nulls.alias("product")).alias("item")))))
    items = F.sort_array(F.collect_list("item"))["product"]
    pages = lines.groupBy("p_brand", "page").agg(
        items.alias("items"), F.min("l_quantity").alias("least"), F.max("l_quantity").alias("most"))
    body = F.concat(F.lit('{"products":['), F.concat_ws(",", "items"), F.lit("]}"))
    fragile = F.col("p_brand") < "Brand#2"
    cut_off = fragile & (F.col("most") <= 35)
    # Stores with an odd number are crawled again: every seventh page is refused, and the first page only answers
    # when it is tried once more.
    again, first = store_no % 2 == 1, F.col("page") == 1
    fetches = F.array_compact(F.array(
        F.struct(F.lit(0).alias("crawl"), F.lit(0).alias("attempt")),
        F.when(again & first, F.struct(F.lit(1).alias("crawl"), F.lit(0).alias("attempt"))),
        F.when(again, F.struct(F.lit(1).alias("crawl"), F.lit(1).alias("attempt")))))
    fetched = pages.select("*", F.inline(fetches))
    second = F.col("crawl") == 1
    return fetched.select(
        F.col("crawl").cast("long").alias("crawl"),
        F.concat(F.lit("brand"), store_no).alias("store"),
        F.concat(F.lit("https://www.brand"), store_no, F.lit(".example.com")).alias("base_url"),
        "page",
        F.when(second & ((F.col("page") % 7 == 3) | (F.col("attempt") == 0)), 429)
        .when(fragile & (F.col("least") >= 15), 500).otherwise(200).alias("status"),
        F.when(cut_off, F.substring(body, 1, 40)).otherwise(body).alias("body"),
        ((F.col("crawl").cast("decimal(38,0)") * F.lit(1 << 60) + store_no.cast("long") * F.lit(1 << 40)
          + F.col("page") * 2 + F.col("attempt")).cast("long")).alias("fetch_seq"),
    )


def event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page with one product per event; its title is absent, null or set in turn."""
    turn = F.col("event_id") % 3
    title = F.when(turn == 0, "").when(turn == 1, '"title":null,').otherwise(
        F.concat(F.lit('"title":"'), "event_type", F.lit('",')))
    body = F.concat(
        F.lit('{"products":[{'), title, F.lit('"vendor":'),
        F.when(F.col("event_type") == "click", "null").otherwise('"v"'),
        F.lit(',"handle":"h'), "event_id", F.lit('","props":'), "props", F.lit("}]}"))
    return table(spark, sf_dir, "events").select(
        F.lit(0).cast("long").alias("crawl"),
        F.concat(F.lit("user"), "user_id").alias("store"),
        F.concat(F.lit("https://user"), "user_id", F.lit(".example.com")).alias("base_url"),
        F.col("event_id").alias("page"),
        F.lit(200).alias("status"),
        body.alias("body"),
        F.col("event_id").alias("fetch_seq"),
    )


def _series():
    """Category number, its page size and the page a part is listed on."""
    series = F.expr(f"p_partkey div {SERIES_SIZE}")
    size = F.when(series % 2 == 0, 16).otherwise(25)
    return series, size, ((F.col("p_partkey") % SERIES_SIZE) / size).cast("bigint")


def _shop(series):
    return F.concat(F.lit("https://shop"), series, F.lit(".example.com"))


def catalogue_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing category per series of parts."""
    numbers = table(spark, sf_dir, "part").select(F.expr(f"p_partkey div {SERIES_SIZE}").alias("n")).distinct()
    return numbers.select(
        F.col("n").alias("seed_no"),
        F.concat(F.lit("Series "), "n").alias("category"),
        F.concat(_shop(F.col("n")), F.lit("/category/")).alias("url"),
    )


def _listing_url(n):
    return F.when(n == 0, "/category/").otherwise(F.concat(F.lit("/category/page/"), n + 1, F.lit("/")))


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages over all parts, at most 25 items each.

    Items carry their link in three kinds of markup, or none. Every page also
    lists the first part of the series before, and links to the next page;
    the last page of a full series links to itself.
    """
    series, size, page = _series()
    path = F.concat(F.lit("/product/"), "p_partkey", F.lit("/"))
    kind = F.col("p_size") % 3
    item = (
        F.when(F.col("p_size") == 50, F.lit('<div class="product-small box"><span>sold</span></div>'))
        .when(kind == 0, F.concat(
            F.lit('<div class="product-small box"><p class="name product-title"><a href="'), _shop(series), path,
            F.lit('">'), "p_name", F.lit("</a></p></div>")))
        .when(kind == 1, F.concat(
            F.lit('<div class="box has-hover product-small"><a href="#quick">+</a>'
                  '<a class="woocommerce-LoopProduct-link x" href="'), path, F.lit('">'), "p_name", F.lit("</a></div>")))
        .otherwise(F.concat(
            F.lit('<div class="col"><div class="product-small box"><a rel="nofollow" href="//shop'), series,
            F.lit(".example.com"), path, F.lit('">'), "p_name", F.lit("<br></a></div>")))
    )
    pages = table(spark, sf_dir, "part").groupBy(
        series.alias("series"), size.alias("size"), page.alias("page")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", item.alias("item")))),
                                 lambda x: x["item"]), "\n").alias("items"))
    n, last = F.col("series"), F.expr(f"{SERIES_SIZE} div size - 1")
    featured = F.when(n > 0, F.concat(
        F.lit('<div class="product-small box"><a href="'), _shop(n - 1), F.lit("/product/"), (n - 1) * SERIES_SIZE,
        F.lit('/">featured</a></div>'))).otherwise("")
    following = _listing_url(F.least(F.col("page") + 1, last))
    return pages.select(
        F.concat(_shop(n), _listing_url(F.col("page"))).alias("url"),
        F.concat(
            F.lit("<html><body><div class=products>"), "items", featured,
            F.lit('</div><ul><li><a class="page-numbers" href="/category/">1</a><li>'
                  '<a class="next page-numbers" href="'), following, F.lit('">next</a></ul></body></html>')).alias("html"),
    )


def product_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One captured page per part; parts of size 48 were not captured."""
    series, _, _ = _series()
    price, kind = _price_text("p_retailprice"), F.col("p_size") % 3
    amount = '<span class="woocommerce-Price-amount amount">'
    price_markup = (
        F.when(F.col("p_size") == 49, F.lit("<p class=price>ask us</p>"))
        .when(kind == 0, F.concat(
            F.lit(f'<p class="price"><del>{amount}<bdi>$9,999.00</bdi></span></del> <ins>{amount}<bdi>'), price,
            F.lit("</bdi></span></ins></p>")))
        .when(kind == 1, F.concat(F.lit(f'<p class="price">{amount}<bdi> '), price, F.lit("\n</bdi></span></p>")))
        .otherwise(F.concat(F.lit(f'<p class="price">{amount}from\n  <b>'), price, F.lit("</b></span></p>")))
    )
    tag = F.when(F.col("p_brand") == "Brand#3", "").otherwise(F.concat(
        F.lit('<span class="tagged_as">Tags: <a href="/t" rel="tag">'), "p_type",
        F.lit('</a>, <a href="/u" rel="tag">other</a></span>')))
    return spread(table(spark, sf_dir, "part"), "p_partkey").where(F.col("p_size") != 48).select(
        F.concat(_shop(series), F.lit("/product/"), "p_partkey", F.lit("/")).alias("url"),
        F.concat(
            F.lit('<!DOCTYPE html><html><head><title>shop</title><script>var h="<h1>x</h1>";</script></head><body>'
                  '<h1 class="product_title entry-title">\n  <i>'), "p_name", F.lit("</i> &amp; more </h1>"),
            price_markup, F.lit('<div class="product_meta"><span class="sku_wrapper">SKU: <span class="sku">P-'),
            "p_partkey", F.lit("</span></span>"), tag, F.lit("</div>")).alias("html"),
    )


def captured_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing and product pages. Some were captured before, when they read differently."""
    now = listing_pages(spark, sf_dir).unionByName(product_pages(spark, sf_dir))
    earlier = F.when(F.col("url").rlike(r"/page/2/$|[05]/$"), F.struct(
        F.replace(F.replace(F.col("html"), F.lit("$"), F.lit("$1")), F.lit("/page/3/"), F.lit("/page/2/")).alias("html"),
        F.lit(0).cast("long").alias("capture_seq")))
    captures = F.array_compact(F.array(F.struct("html", F.lit(1).cast("long").alias("capture_seq")), earlier))
    return now.select("url", F.explode(captures).alias("capture")).select("url", "capture.html", "capture.capture_seq")


def web_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crawled pages, each captured once."""
    return spread(table(spark, sf_dir, "pages"), "page_id").select(
        "page_id", "url", "html", F.col("page_id").alias("capture_seq"))


def page_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page of each site as a start point."""
    site = F.regexp_extract("url", "^https?://([^/?#]+)", 1)
    firsts = table(spark, sf_dir, "pages").groupBy(site.alias("category")).agg(
        F.min("page_id").alias("seed_no"), F.min_by("url", "page_id").alias("url"))
    return firsts.select("seed_no", "category", "url")


def page_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``url, next_url``: each page points to the one after it.

    A URL that stands for several pages goes on with the next URL that sorts first.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    following = pages.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("next_url"))
    return pages.join(following, "page_id").where(F.col("url") != F.col("next_url")).select("url", "next_url")
