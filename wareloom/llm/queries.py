"""The corpus operators over the test tables, by name, and their SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import functions as F

import public_tokenizers

from wareloom.llm import (
    bpe, decontaminate, divergence, filter_audit, language, line_dedup, near_dup, pii, quality, repeats, spotsigs,
    url_filter, warc)
from wareloom.llm.common import table

TOKENIZER = "byte_bpe_multi_50k.tiktoken"

LLM_QUERIES = {}
LLM_ORACLES = {}


def query(function):
    LLM_QUERIES[function.__name__] = function
    return function


@query
def op1_bpe(spark, sf_dir):
    """Ids of every whole text and the bytes they decode to, as digests."""
    ranks, pattern = bpe.read_ranks(public_tokenizers.path(TOKENIZER)), public_tokenizers.PATTERN
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks, pattern)
    return bpe.digests(bpe.decode(encoded, ranks, pattern))


@query
def op2_pii(spark, sf_dir):
    """Personal data in every document, and the terms nearby that give it away."""
    found = pii.protect(table(spark, sf_dir, "documents"))
    counts = [pii.count_of(kind).alias(f"n_{kind}") for kind in pii.PATTERNS]
    digest = F.sha2(pii.as_text("base"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, pii.as_text("spans").alias("spans"))


@query
def op3_quality(spark, sf_dir):
    """Every document's quality score and verdict."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_language(spark, sf_dir):
    """Every document's language."""
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs))


@query
def op5_near_dup(spark, sf_dir):
    """Every document with the class of its near copies."""
    return near_dup.classes(table(spark, sf_dir, "documents"))


@query
def op6_spotsigs(spark, sf_dir):
    """Every document's fingerprint, that of its edited text, and their likeness."""
    return spotsigs.edited(table(spark, sf_dir, "documents"))


@query
def op7_url_filter(spark, sf_dir):
    """The verdict on every page's URL."""
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")


@query
def op8_warc(spark, sf_dir):
    """Every page written to an archive, found again through the index and read back."""
    pages = table(spark, sf_dir, "pages")
    folder, shards = warc.archive(spark, pages)
    captures = warc.lookup(shards, pages.select(warc.url_key(F.col("url")).alias("key")), folder)
    return warc.read_records(captures, folder)


# SHA-1 is 40 hexadecimal digits, five of which make four digits to the base 32.
LLM_ORACLES["op8_warc"] = """
WITH payloads AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), firsts AS (
    SELECT hex, min(page_id) AS first FROM payloads GROUP BY hex
), digits AS (
    SELECT payloads.*, first, [list_sum([(strpos('0123456789abcdef', substr(hex, n * 5 + k, 1)) - 1) * 16 ** (5 - k)
                                         for k in range(1, 6)])::BIGINT for n in range(0, 8)] AS parts
    FROM payloads JOIN firsts USING (hex)
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((parts[n // 4 + 1] // (32 ** (3 - n % 4))::BIGINT) % 32 AS INTEGER) + 1, 1) for n in range(0, 32)], '')
           AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM digits
"""


@query
def op9_line_dedup(spark, sf_dir):
    """Every document with its text after cross-site boilerplate is gone."""
    cleaned = line_dedup.remove_boilerplate(table(spark, sf_dir, "documents"))
    return cleaned.select("row.doc_id", "n_lines", "n_removed", "text")


LLM_ORACLES["op9_line_dedup"] = r"""
WITH lines AS (
    SELECT doc_id, source, trim(line, E' \t\r') AS line
    FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents)
    WHERE regexp_matches(line, '\S')
), listed AS (
    SELECT line, min(doc_id) AS first_doc FROM lines GROUP BY line HAVING count(DISTINCT source) >= 5
), placed AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           unnest(range(len(string_split(text, chr(10))))) AS place
    FROM documents
), marked AS (
    SELECT placed.doc_id, place, placed.line, listed.line IS NOT NULL AND placed.doc_id > first_doc AS gone
    FROM placed LEFT JOIN listed ON trim(placed.line, E' \t\r') = listed.line
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '') AS text
FROM marked GROUP BY doc_id
"""


@query
def op10_decontaminate(spark, sf_dir):
    """Documents and the benchmark items they hold."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_source_divergence(spark, sf_dir):
    """Each source's distance from the others of its language, and the terms it has more of."""
    return divergence.audit(table(spark, sf_dir, "documents"))


LLM_ORACLES["op11_source_divergence"] = r"""
WITH texts AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), found AS (
    SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM texts
), kept AS (
    SELECT lang, term, count(*) AS n FROM found GROUP BY lang, term HAVING count(DISTINCT row) >= 10
), langs AS (
    SELECT lang, count(*) AS terms, sum(n) AS total FROM kept GROUP BY lang
), every AS (
    SELECT DISTINCT lang, source FROM texts
), counted AS (
    SELECT lang, source, term, count(*) AS n FROM found GROUP BY lang, source, term
), totals AS (
    SELECT lang, source, sum(n) AS total FROM counted SEMI JOIN kept USING (lang, term) GROUP BY lang, source
), grid AS (
    SELECT every.lang, every.source, kept.term, coalesce(counted.n, 0) AS n,
           1 + 1000000000::HUGEINT * (coalesce(counted.n, 0) + 2) // (coalesce(totals.total, 0) + 2 * langs.terms) AS p,
           1 + 1000000000::HUGEINT * (kept.n + 2) // (langs.total + 2 * langs.terms) AS q
    FROM every JOIN kept USING (lang) JOIN langs USING (lang)
    LEFT JOIN counted ON counted.lang = every.lang AND counted.source = every.source AND counted.term = kept.term
    LEFT JOIN totals ON totals.lang = every.lang AND totals.source = every.source
), apart AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), items AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM every a JOIN every b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM grid WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM items
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@query
def op12_filter_audit(spark, sf_dir):
    """What five filters remove, step by step, in all orders they can be applied in."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


LLM_ORACLES["op12_filter_audit"] = r"""
WITH marks AS (
    SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id
), texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), judged AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
           {'A': len(words) < 200, 'B': 100 * len(list_distinct(words)) < 50 * len(words),
            'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
            'D': regexp_matches(text, '[#$%&*|]'),
            'E': coalesce(min(doc_id) OVER (PARTITION BY text) < doc_id, false)} AS failed
    FROM texts LEFT JOIN marks USING (doc_id)
), masks AS (
    SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
    FROM judged GROUP BY part, failed
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l
), orders AS (
    SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), fails AS (
    SELECT part, n, good, toxic, unnest(['A', 'B', 'C', 'D', 'E']) AS letter,
           unnest([failed.A, failed.B, failed.C, failed.D, failed.E]) AS fails,
           list_filter(['A', 'B', 'C', 'D', 'E'], lambda l: CASE l WHEN 'A' THEN failed.A WHEN 'B' THEN failed.B
               WHEN 'C' THEN failed.C WHEN 'D' THEN failed.D ELSE failed.E END) AS every
    FROM masks
), steps AS (
    SELECT part, filter_order, step, n, good, toxic, fails, every,
           len(list_filter(every, lambda l: strpos(filter_order, l) < step)) > 0 AS before
    FROM (SELECT *, unnest(range(1, 6)) AS step FROM orders) JOIN fails ON letter = substr(filter_order, step, 1)
), counted AS (
    SELECT part, filter_order, CAST(step AS INTEGER) AS step,
           coalesce(sum(n) FILTER (NOT fails AND NOT before), 0) AS kept,
           coalesce(sum(n) FILTER (fails AND NOT before), 0) AS removed,
           coalesce(sum(n) FILTER (fails AND before), 0) AS redundant,
           coalesce(sum(n) FILTER (fails AND len(every) = 1), 0) AS unique_fails,
           coalesce(sum(good) FILTER (fails AND NOT before), 0) AS good_lost,
           coalesce(sum(toxic) FILTER (fails AND NOT before), 0) AS toxic_lost
    FROM steps GROUP BY part, filter_order, step
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1)) AS BIGINT) AS shapley
FROM counted
"""


@query
def op13_repeats(spark, sf_dir):
    """Every document without the 400-byte strings that also stand elsewhere."""
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    n_removed = F.col("n_bytes") - F.octet_length("kept")
    return found.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"), "n_shared_marks")
