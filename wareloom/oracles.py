"""The same queries as plain SQL on the test tables, for comparison.

Written from what each result means, not from the operators: pages and feeds
are never built here, their expected contents are derived from the base rows.
"""

from __future__ import annotations

WHITE_SPACE = "".join(f"chr({c})||" for c in [*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203),
                                              8232, 8233, 8239, 8287, 12288]).rstrip("|")

STRUCTURED = """structured AS (
  SELECT CASE WHEN l_quantity <> 1 THEN 'https://s' || l_suppkey || '.example.com/products/' || l_partkey END AS product_url,
         p_name AS title, p_brand AS vendor,
         CASE WHEN l_linenumber <> 7 THEN l_extendedprice END AS price,
         CASE WHEN l_linestatus = 'O' THEN 'Available' ELSE 'Out of Stock' END AS availability,
         '<p> ' || p_type || ' <b>' || p_size || '</b></p>' AS description,
         p_type AS category, s_name AS store_name,
         CAST((CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) * 1099511627776
               + l_orderkey) * 8 + l_linenumber AS BIGINT) AS ordinal
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""

SCRAPED = """scraped AS (
  SELECT 'https://s' || (o_custkey // 10) || '.example.com/products/' || (o_orderkey // 4) AS product_url,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' OR o_orderstatus <> 'F' THEN 'Order ' || o_orderkey END AS title,
         CASE WHEN o_orderstatus = 'P' THEN 'N/A' ELSE '$' || format('{:,.2f}', o_totalprice) END AS price,
         CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS tag,
         'SKU-' || o_orderkey AS sku, o_orderpriority AS category, o_orderkey AS ordinal
  FROM orders)"""

SCANS = f"""{STRUCTURED}, {SCRAPED},
structured_scan AS (
  SELECT product_url, title, vendor, price, availability, description, category AS product_category,
         store_name AS source_store_name, 'Shopify' AS source_platform,
         CAST(NULL AS VARCHAR) AS product_tags, CAST(NULL AS VARCHAR) AS sku, 0 AS source_priority, ordinal
  FROM structured WHERE price IS NOT NULL AND title IS NOT NULL),
scraped_scan AS (
  SELECT product_url, title, 'Barefoot Buttons' AS vendor, price, 'Available' AS availability,
         CAST(NULL AS VARCHAR) AS description, category AS product_category,
         'Barefoot Buttons' AS source_store_name, 'WooCommerce' AS source_platform,
         tag AS product_tags, sku, 1 AS source_priority, ordinal
  FROM scraped WHERE price IS NOT NULL AND title IS NOT NULL)"""

COMBINED = f"""{SCANS},
combined AS (
  SELECT * FROM structured_scan
  UNION ALL
  SELECT product_url, title, vendor,
         TRY_CAST(NULLIF(regexp_replace(price, '[^0-9.]', '', 'g'), '') AS DOUBLE) AS price,
         availability, description, product_category, source_store_name, source_platform, product_tags, sku,
         source_priority, ordinal
  FROM scraped_scan)"""

HARMONISED = f"""{COMBINED},
harmonised AS (
  SELECT * EXCLUDE (position) FROM (
    SELECT *, row_number() OVER (PARTITION BY product_url ORDER BY source_priority, ordinal) AS position FROM combined)
  WHERE position = 1)"""


def preprocessed(source: str) -> str:
    return f"""preprocessed AS (
  SELECT product_url, COALESCE(title, 'N/A') AS title, COALESCE(vendor, 'N/A') AS vendor, price, availability, description,
         COALESCE(product_category, 'N/A') AS product_category,
         COALESCE(source_store_name, 'N/A') AS source_store_name, source_platform,
         COALESCE(product_tags, 'N/A') AS product_tags, COALESCE(sku, 'N/A') AS sku, source_priority, ordinal,
         CASE WHEN lower(availability) = 'available' THEN 1 ELSE 0 END AS is_available_numeric,
         trim(regexp_replace(COALESCE(description, ''), '<[^\\n]*?>', '', 'g')) AS description_text
  FROM {source} WHERE price IS NOT NULL)"""


SCORES = """bounds AS (SELECT min(price) AS low, max(price) AS high FROM preprocessed),
scores AS (
  SELECT preprocessed.*, is_available_numeric AS availability_score,
         CASE WHEN high = low THEN 0.5::DOUBLE ELSE (high - price) / (high - low) END AS price_score
  FROM preprocessed, bounds),
scored AS (
  SELECT *, availability_score * 0.6::DOUBLE + price_score * 0.4::DOUBLE AS final_score FROM scores)"""

SCORED = f"{HARMONISED}, {preprocessed('harmonised')}, {SCORES}"

TOP_K = f"""WITH {SCORED}
SELECT CAST(row_number() OVER (ORDER BY final_score DESC, product_url) AS INTEGER) AS rank_overall,
       title, source_store_name, price, is_available_numeric, round(final_score, 6) AS final_score, product_url,
       source_platform
FROM (SELECT * FROM scored ORDER BY final_score DESC, product_url LIMIT 20)"""

PLATFORMS = """platforms AS (
  SELECT source_store_name, source_platform FROM (
    SELECT source_store_name, source_platform,
           row_number() OVER (PARTITION BY source_store_name ORDER BY source_priority, ordinal) AS n FROM scored)
  WHERE n = 1)"""

# One row per feed product, with the page it is on and its position there.
FEED = """lines AS (
  SELECT *, CAST(substr(p_brand, 7) AS INTEGER) AS store_no, l_orderkey // 100 + 1 AS page,
         'https://www.brand' || substr(p_brand, 7) || '.example.com' AS base_url,
         format('{:.2f}', l_extendedprice) AS plain,
         row_number() OVER (PARTITION BY p_brand, l_orderkey // 100
                            ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate) - 1 AS pos
  FROM lineitem JOIN part ON l_partkey = p_partkey),
feed_pages AS (
  SELECT store_no, page,
         p_brand < 'Brand#2' AND (min(l_quantity) >= 15 OR max(l_quantity) <= 35) AS bad
  FROM lines GROUP BY store_no, p_brand, page),
crawled AS (
  SELECT *, row_number() OVER (PARTITION BY crawl, store_no ORDER BY page) AS expected FROM (
    SELECT CAST(0 AS BIGINT) AS crawl, store_no, page, bad FROM feed_pages
    UNION ALL
    SELECT 1, store_no, page, bad OR page % 7 = 3 FROM feed_pages WHERE store_no % 2 = 1)),
stops AS (
  SELECT crawl, store_no, COALESCE(min(page) FILTER (bad OR page <> expected), 9223372036854775807) AS stop
  FROM crawled GROUP BY crawl, store_no),
read AS (
  SELECT crawl, 'brand' || store_no AS store, page, CAST(pos AS INTEGER) AS pos,
         CASE WHEN l_quantity = 1 THEN 'N/A'
              ELSE base_url || '/products/' || l_partkey || '-' || l_suppkey END AS product_url,
         CASE WHEN l_linenumber = 7 THEN 'N/A'
              WHEN l_linenumber = 6 AND l_returnflag = 'A' THEN NULL ELSE p_name END AS title,
         CASE WHEN l_linenumber <> 5 THEN p_brand END AS vendor,
         CASE WHEN l_linenumber IN (1, 2) AND l_returnflag = 'R' THEN 0.0::DOUBLE
              WHEN l_linenumber = 4 AND l_linestatus = 'F' AND l_returnflag = 'N' THEN NULL
              ELSE CAST(plain AS DOUBLE) END AS price,
         CASE WHEN l_linestatus = 'O' AND NOT (l_linenumber = 1 AND l_returnflag = 'R')
              THEN 'Available' ELSE 'Out of Stock' END AS availability,
         '<p>' || p_type || '</p>' AS description, p_type AS category, 'brand' || store_no AS store_name,
         store_no
  FROM lines JOIN stops USING (store_no) WHERE page < stop),
flat AS (
  SELECT *, CASE WHEN price IS NULL THEN 'bad price' WHEN title IS NULL THEN 'title is null' END AS reject_reason
  FROM read)"""

INGESTED = f"""WITH {FEED}
SELECT product_url, title, vendor, price, availability, description, category, store_name FROM (
  SELECT *, row_number() OVER (PARTITION BY product_url ORDER BY crawl DESC, store_no DESC, page DESC, pos DESC) AS n
  FROM flat WHERE reject_reason IS NULL)
WHERE n = 1"""

LINKS = """site AS (SELECT page_id, url, regexp_extract(url, '^https?://([^/?#]+)', 1) AS category,
                regexp_extract(url, '^https?://[^/?#]+', 0) AS root,
                regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs FROM pages),
links AS (SELECT page_id, url, category, CAST(generate_subscripts(hrefs, 1) - 1 AS INTEGER) AS pos,
                 root || unnest(hrefs) AS link FROM site)"""

# Series of 400 parts; 16 or 25 to a listing page.
PLACED = """placed AS (
  SELECT p_partkey // 400 AS series, p_partkey AS part, p_size,
         p_partkey % 400 // CASE WHEN p_partkey // 400 % 2 = 0 THEN 16 ELSE 25 END AS page FROM part)"""

LISTED = """listed AS (
  SELECT p_partkey // 400 AS series, p_partkey AS part FROM part WHERE p_size <> 50
  UNION
  SELECT DISTINCT p_partkey // 400, (p_partkey // 400 - 1) * 400 FROM part WHERE p_partkey >= 400),
category_links AS (
  SELECT series, part, 'https://shop' || (part // 400) || '.example.com/product/' || part || '/' AS link FROM listed)"""


def decoded(column: str) -> str:
    """Character references; HTML reads these few also without their semicolon."""
    for name, text in [("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("amp", "&")]:
        column = f"regexp_replace({column}, '&{name};?', '{text}', 'g')"
    return column


def element(pattern: str) -> str:
    return f"COALESCE(NULLIF(trim({decoded(f'regexp_extract(html, {pattern!r}, 1)')}), ''), 'N/A')"


PAGE_COUNTS = f"""WITH {LISTED}
SELECT 'Series ' || series AS category, count(*) AS links, count(*) FILTER (p_size <> 48) AS captured
FROM category_links JOIN part ON part = p_partkey GROUP BY series"""

PRODUCT_FIELDS = """p_name || ' & more' AS title,
               CASE WHEN p_size = 49 THEN 'N/A' WHEN p_size % 3 = 2 THEN 'from ' ELSE '' END
                 || CASE WHEN p_size <> 49 THEN '$' || format('{:,.2f}', p_retailprice) ELSE '' END AS price,
               CASE WHEN p_brand = 'Brand#3' THEN 'N/A' ELSE p_type END AS tag, 'P-' || p_partkey AS sku"""


def alone(platform: str) -> str:
    """Scores of a run on one source only."""
    return f"""(WITH {COMBINED},
          only_one AS (SELECT * EXCLUDE (position) FROM (
            SELECT *, row_number() OVER (PARTITION BY product_url ORDER BY ordinal) AS position
            FROM combined WHERE source_platform = '{platform}') WHERE position = 1),
          {preprocessed('only_one')}, {SCORES}
          SELECT COALESCE(product_url, 'N/A') AS product_url, source_platform, price,
                 round(CAST(CAST(final_score AS FLOAT) AS DOUBLE), 6) AS final_score FROM scored)"""


ORACLES = {
    "structured_scan": f"WITH {SCANS} SELECT * FROM structured_scan",
    "scraped_scan": f"WITH {SCANS} SELECT * FROM scraped_scan",
    "align_union": f"WITH {COMBINED} SELECT * FROM combined",
    "dedupe_keep_first": f"WITH {HARMONISED} SELECT product_url, source_platform, source_priority, ordinal FROM harmonised",
    "clean_price": """
        SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN o_totalprice WHEN '2-HIGH' THEN o_totalprice
                           WHEN '5-LOW' THEN abs(o_totalprice) END AS price
        FROM orders WHERE o_orderpriority NOT IN ('3-MEDIUM', '4-NOT SPECIFIED')""",
    "availability_flag": """
        SELECT l_orderkey, l_linenumber, l_partkey,
               CASE WHEN l_linestatus = 'F' OR l_returnflag = 'N' THEN 0 ELSE 1 END AS is_available_numeric
        FROM lineitem""",
    "strip_html": f"""
        SELECT page_id, trim(regexp_replace(html, '<[^\\n]*?>', '', 'g'), {WHITE_SPACE}) AS description_text FROM pages""",
    "fill_missing": f"""WITH {COMBINED}
        SELECT product_url, COALESCE(title, 'N/A') AS title, COALESCE(vendor, 'N/A') AS vendor, price, availability,
               description, COALESCE(product_category, 'N/A') AS product_category,
               COALESCE(source_store_name, 'N/A') AS source_store_name, source_platform,
               COALESCE(product_tags, 'N/A') AS product_tags, COALESCE(sku, 'N/A') AS sku, source_priority, ordinal
        FROM combined""",
    "harmonise": f"WITH {HARMONISED} SELECT * FROM harmonised",
    "preprocess": f"WITH {HARMONISED}, {preprocessed('harmonised')} SELECT * FROM preprocessed",
    "single_source_run": f"""WITH {SCANS},
        only_one AS (SELECT * EXCLUDE (position) FROM (
          SELECT *, row_number() OVER (PARTITION BY product_url ORDER BY ordinal) AS position FROM structured_scan)
          WHERE position = 1),
        {preprocessed('only_one')}, {SCORES}
        SELECT product_url, source_platform, price, round(final_score, 6) AS final_score FROM scored""",
    "price_score": """
        WITH bounds AS (SELECT min(l_extendedprice) AS low, max(l_extendedprice) AS high FROM lineitem)
        SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS price,
               round((high - l_extendedprice) / (high - low), 6) AS price_score FROM lineitem, bounds""",
    "attractiveness_score": f"""WITH {SCORED}
        SELECT product_url, title, source_store_name, price, availability_score, round(price_score, 6) AS price_score,
               round(final_score, 6) AS final_score FROM scored""",
    "top_k_overall": TOP_K,
    "rank_all": f"""WITH {SCORED}
        SELECT CAST(row_number() OVER (ORDER BY final_score DESC, product_url NULLS FIRST) AS INTEGER) AS rank_overall,
               product_url, source_platform FROM scored""",
    "flagship_per_store": f"""WITH {SCORED}
        SELECT CAST(n AS INTEGER) AS store_rank, source_store_name, title, round(final_score, 6) AS final_score, price,
               product_url, source_platform
        FROM (SELECT *, row_number() OVER (PARTITION BY source_store_name
                ORDER BY final_score DESC, source_priority, ordinal, product_url) AS n FROM scored)
        WHERE n <= 3""",
    "store_avg_rank": f"""WITH {SCORED}
        SELECT source_store_name, round(avg(final_score), 6) AS avg_product_score FROM scored GROUP BY 1""",
    "store_max_rank": f"""WITH {SCORED}
        SELECT source_store_name, round(max(final_score), 6) AS max_product_score FROM scored GROUP BY 1""",
    "store_platform_map": f"WITH {SCORED}, {PLATFORMS} SELECT * FROM platforms",
    "store_rankings": f"""WITH {SCORED}, {PLATFORMS}
        SELECT source_store_name, round(avg(final_score), 6) AS avg_product_score,
               round(max(final_score), 6) AS max_product_score, any_value(platforms.source_platform) AS source_platform
        FROM scored JOIN platforms USING (source_store_name) GROUP BY 1""",
    "store_rankings_joined": f"""WITH {SCORED}, {PLATFORMS}
        SELECT source_store_name, round(avg(final_score), 6) AS avg_product_score,
               round(max(final_score), 6) AS max_product_score,
               CASE WHEN source_store_name = 'Barefoot Buttons' THEN 'Unknown'
                    ELSE any_value(platforms.source_platform) END AS source_platform
        FROM scored JOIN platforms USING (source_store_name) GROUP BY 1""",
    "feed_contiguous_pages": f"""WITH {FEED}
        SELECT crawl, 'brand' || store_no AS store, page FROM crawled JOIN stops USING (crawl, store_no)
        WHERE page < stop""",
    "feed_flatten": f"WITH {FEED} SELECT * EXCLUDE (store_no, reject_reason) FROM flat WHERE reject_reason IS NULL",
    "feed_missing_vs_null": """
        SELECT 'https://user' || user_id || '.example.com/products/h' || event_id AS product_url,
               CASE event_id % 3 WHEN 0 THEN 'N/A' WHEN 2 THEN event_type END AS title,
               CASE WHEN event_type <> 'click' THEN 'v' END AS vendor, '' AS description, 'N/A' AS category,
               0.0::DOUBLE AS price, CASE event_id % 3 WHEN 1 THEN 'title is null' END AS reject_reason
        FROM events""",
    "feed_rejects": f"""WITH {FEED}
        SELECT crawl, store, page, pos, reject_reason FROM flat WHERE reject_reason IS NOT NULL""",
    "run_feed_rejects": f"""WITH {FEED}
        SELECT crawl, store, page, pos, reject_reason FROM flat WHERE reject_reason IS NOT NULL""",
    "run_stream_rejects": f"""WITH {FEED}
        SELECT crawl, store, page, pos, reject_reason FROM flat WHERE reject_reason IS NOT NULL""",
    "silent_stores": f"""WITH {FEED},
        listed AS (SELECT DISTINCT CAST(substr(p_brand, 7) AS BIGINT) AS seed_no FROM part UNION SELECT 900)
        SELECT seed_no, 'https://www.brand' || seed_no || '.example.com' AS base_url, 'brand' || seed_no AS store
        FROM listed WHERE seed_no NOT IN (SELECT store_no FROM feed_pages WHERE NOT bad)""",
    "run_feed_silent": f"""WITH {FEED},
        listed AS (SELECT DISTINCT CAST(substr(p_brand, 7) AS BIGINT) AS seed_no FROM part UNION SELECT 900)
        SELECT seed_no, 'https://www.brand' || seed_no || '.example.com' AS base_url, 'brand' || seed_no AS store
        FROM listed WHERE seed_no NOT IN (SELECT store_no FROM feed_pages WHERE NOT bad)""",
    "store_name_from_url": """
        SELECT page_id, split_part(replace(replace(url, 'https://www.', ''), 'https://', ''), '.', 1) AS store_name
        FROM pages""",
    "page_links": f"""WITH {PLACED},
        items AS (
          SELECT series, page, 0 AS part_of, part FROM placed WHERE p_size <> 50
          UNION ALL
          SELECT DISTINCT series, page, 1, (series - 1) * 400 FROM placed WHERE series > 0)
        SELECT 'https://shop' || series || '.example.com/category/'
                 || CASE WHEN page > 0 THEN 'page/' || (page + 1) || '/' ELSE '' END AS url,
               CAST(row_number() OVER (PARTITION BY series, page ORDER BY part_of, part) - 1 AS INTEGER) AS pos,
               'https://shop' || (part // 400) || '.example.com/product/' || part || '/' AS link
        FROM items""",
    "resolve_links": f"""WITH {LINKS},
        parts AS (SELECT url, pos, link, substr(link, length(regexp_extract(link, '^https?://[^/?#]+', 0)) + 1) AS href FROM links)
        SELECT url, pos, 0 AS kind, link FROM parts
        UNION ALL SELECT url, pos, 1, 'https://other.example.com' || href FROM parts
        UNION ALL SELECT url, pos, 2, regexp_extract(url, '^https?', 0) || '://other.example.com' || href FROM parts
        UNION ALL SELECT url, pos, 3, link FROM parts
        UNION ALL SELECT url, pos, 4, regexp_extract(url, '^[^?#]*', 0) || '?from=' || pos FROM parts""",
    "distinct_links_ordered": f"""WITH {LINKS}
        SELECT category, link, min(page_id * 2147483648 + pos) AS ordinal FROM links GROUP BY category, link""",
    "pagination_chain": """
        WITH RECURSIVE edges AS (
          SELECT a.url, min(b.url) AS next_url FROM pages a JOIN pages b ON b.page_id = a.page_id + 1
          WHERE a.url <> b.url GROUP BY a.url),
        walk AS (
          SELECT min(page_id) AS seed_no, 0 AS hop, arg_min(url, page_id) AS page_url, [arg_min(url, page_id)] AS path
          FROM pages GROUP BY regexp_extract(url, '^https?://([^/?#]+)', 1)
          UNION ALL
          SELECT seed_no, hop + 1, next_url, list_append(path, next_url) FROM walk JOIN edges ON page_url = url
          WHERE NOT list_contains(path, next_url))
        SELECT seed_no, CAST(hop AS INTEGER) AS hop, page_url FROM walk""",
    "extract_page_fields": f"""
        SELECT url, {element('<h1>(.*?)</h1>')} AS title, {element('<title>(.*?)</title>')} AS head,
               {element('<li><a[^>]*>[^<]*</a></li><li><a[^>]*>([^<]*)</a>')} AS second_link, 'N/A' AS sku
        FROM pages""",
    "extract_product_fields": f"""
        SELECT 'https://shop' || (p_partkey // 400) || '.example.com/product/' || p_partkey || '/' AS url, {PRODUCT_FIELDS}
        FROM part WHERE p_size <> 48""",
    "cut_chains": f"""WITH {PLACED}
        SELECT DISTINCT series AS seed_no, 'Series ' || series AS category,
               'https://shop' || series || '.example.com/category/page/11/' AS next_url
        FROM placed WHERE page >= 9""",
    "run_pages_cut": f"""WITH {PLACED}
        SELECT DISTINCT series AS seed_no, 'Series ' || series AS category,
               'https://shop' || series || '.example.com/category/page/11/' AS next_url
        FROM placed WHERE page >= 9""",
    "run_selection_twice": f"""WITH second AS {alone('WooCommerce')}, first AS {alone('Shopify')}
        SELECT * FROM second UNION ALL SELECT * FROM first WHERE product_url NOT IN (SELECT product_url FROM second)""",
    "missing_pages": f"""WITH {LISTED}
        SELECT 'Series ' || series AS category, link FROM category_links JOIN part ON part = p_partkey WHERE p_size = 48""",
    "upsert_latest": f"""WITH {STRUCTURED}
        SELECT product_url, title, vendor, price, ordinal FROM (
          SELECT * REPLACE (COALESCE(product_url, 'N/A') AS product_url),
                 row_number() OVER (PARTITION BY product_url ORDER BY ordinal DESC) AS n FROM structured)
        WHERE n = 1""",
    "compacted_products": f"SELECT *, true AS stamped FROM ({INGESTED})",
    "upsert_folded_key": """
        WITH keyed AS (SELECT *, CASE WHEN page_id % 2 = 1 THEN upper(host) ELSE host END AS written FROM (
          SELECT page_id, url, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host FROM pages))
        SELECT arg_min(written, page_id) AS host, arg_max(url, page_id) AS url, max(page_id) AS page_id
        FROM keyed GROUP BY lower(substr(written, 1, 255))""",
    "save_shape": f"""WITH {SCORED}
        SELECT COALESCE(product_url, 'N/A') AS product_url, title, source_store_name, price, is_available_numeric,
               description_text, product_category, product_tags, 'N/A' AS sku, source_platform,
               CAST(availability_score AS DOUBLE) AS availability_score, round(price_score, 6) AS price_score,
               round(final_score, 6) AS final_score FROM scored""",
    "contract_violations": f"""WITH {COMBINED}
        SELECT 'product_url' AS column_name, 'not null' AS rule, count(*) FILTER (product_url IS NULL) AS violations FROM combined
        UNION ALL SELECT 'title', 'not null', count(*) FILTER (title IS NULL) FROM combined
        UNION ALL SELECT 'price', 'not null', count(*) FILTER (price IS NULL) FROM combined
        UNION ALL SELECT 'product_url', 'length <= 36', count(*) FILTER (length(product_url) > 36) FROM combined
        UNION ALL SELECT 'title', 'length <= 10', count(*) FILTER (length(title) > 10) FROM combined
        UNION ALL SELECT 'price', 'decimal(6,2)', count(*) FILTER (round(price, 2) >= 10000) FROM combined
        UNION ALL SELECT 'product_url', 'unique', count(product_url) - count(DISTINCT product_url) FROM combined""",
    "contract_split": f"""WITH {COMBINED}
        SELECT * FROM (
          SELECT product_url, title, price, source_priority, ordinal,
                 CASE WHEN product_url IS NULL THEN 'product_url: not null' WHEN price IS NULL THEN 'price: not null'
                      WHEN length(product_url) > 36 THEN 'product_url: length <= 36'
                      WHEN length(title) > 10 THEN 'title: length <= 10'
                      WHEN round(price, 2) >= 10000 THEN 'price: decimal(6,2)' END AS reject_reason FROM combined)
        WHERE reject_reason IS NOT NULL""",
    "evolve_union": f"""WITH {SCRAPED}
        SELECT product_url, title, price, sku, ordinal, 'older' AS age, CAST(NULL AS VARCHAR) AS category,
               CAST(NULL AS VARCHAR) AS tag FROM scraped
        UNION ALL
        SELECT product_url, title, price, sku, ordinal, 'newer', category, NULL FROM scraped""",
    "refresh_guard": TOP_K,
    "ingest_stream": INGESTED,
    "run_counters": f"""WITH {HARMONISED}
        SELECT source_platform, source_store_name, product_category, count(*) AS rows FROM harmonised GROUP BY ALL""",
    "feed_counters": f"""WITH {FEED}
        SELECT crawl, store, page, count(*) FILTER (reject_reason IS NULL) AS accepted,
               count(*) FILTER (reject_reason IS NOT NULL) AS rejected FROM flat GROUP BY crawl, store, page""",
    "page_counters": PAGE_COUNTS,
    "run_pages_counts": PAGE_COUNTS,
    "ingest_feed": INGESTED,
    "ingest_pages": f"""WITH {LISTED},
        latest AS (SELECT part, link, max(series) AS series FROM category_links GROUP BY part, link)
        SELECT link AS product_url, {PRODUCT_FIELDS}, 'Series ' || series AS category
        FROM latest JOIN part ON part = p_partkey WHERE p_size <> 48""",
    "run_selection": f"""WITH {SCORED}
        SELECT COALESCE(product_url, 'N/A') AS product_url, title, source_store_name, price,
               CAST(is_available_numeric AS TINYINT) AS is_available_numeric,
               description_text, product_category, product_tags, sku, source_platform,
               CAST(availability_score AS DOUBLE) AS availability_score,
               round(CAST(CAST(price_score AS FLOAT) AS DOUBLE), 6) AS price_score,
               round(CAST(CAST(final_score AS FLOAT) AS DOUBLE), 6) AS final_score FROM scored""",
    "run_selection_rankings": f"""WITH {SCORED}, {PLATFORMS}
        SELECT source_store_name, round(CAST(CAST(avg(final_score) AS FLOAT) AS DOUBLE), 6) AS avg_product_score,
               round(CAST(CAST(max(final_score) AS FLOAT) AS DOUBLE), 6) AS max_product_score,
               any_value(platforms.source_platform) AS source_platform
        FROM scored JOIN platforms USING (source_store_name) GROUP BY 1""",
}
