"""The source audit against SQL and against plain counting, also with digests that collide."""

import os
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F
from rows import documents, odd_rows

from wareloom.llm import divergence
from wareloom.llm.queries import LLM_ORACLES, LLM_QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_query_matches_sql(spark):
    sql = duckdb.connect()
    sql.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    wanted = sql.execute(LLM_ORACLES["op11_source_divergence"])
    names = [column[0] for column in wanted.description]
    got = LLM_QUERIES["op11_source_divergence"](spark, SF_DIR).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(wanted.fetchall())
    assert {row.part for row in got} == {"pair", "term"}


def by_counting(rows, min_docs, top):
    """All groups by all terms, in Python's whole numbers."""
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, _ in rows:
        text, lang, source = text or "", lang or "", source or ""
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        groups[lang].add(source)
        count[lang, source].update(terms)
        docs[lang].update(set(terms))
    found = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + divergence.SCALE * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}
        p = {s: shares(count[lang, s]) for s in sources}
        q = shares(sum((count[lang, s] for s in sources), Counter()))
        apart = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(-sum(apart(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            more = [(-apart(p[s][t], q[t]), t.encode()) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(more)[:top])):
                found += [(lang, s, part, item.decode(), -value, n) for n, (value, item) in enumerate(items, 1)]
    return sorted(found)


def audited(docs, **how):
    return sorted(map(tuple, divergence.audit(docs, **how).collect()))


def corpus(seed=3, docs=60):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdeXYZéß漢" for b in "klmnoΣ"]
    return [(n, " ".join(rng.choices(words[:rng.randrange(5, 60)], k=rng.randrange(40))), rng.choice(["en", "de"]),
             rng.choice("stuvw"), 0) for n in range(docs)]


@pytest.mark.parametrize("bits", [64, 5, 1])
def test_equals_counting_whatever_digests_collide(spark, bits):
    rows = corpus()
    assert audited(documents(spark, rows), min_docs=5, top=4, bits=bits) == by_counting(rows, 5, 4)


def test_blocks_buckets_and_handing_on(spark, monkeypatch):
    """Many small parts add up to the same."""
    rows = corpus(8, 80)
    for name, value in {"BLOCK_SOURCES": 2, "BUCKET_TERMS": 7}.items():
        monkeypatch.setattr(divergence, name, value)
    assert audited(documents(spark, rows), min_docs=3, top=5) == by_counting(rows, 3, 5)


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = " ".join(corpus()[n][1] for n in range(20)).encode()
    whole = Counter(divergence.TERM.findall(text.lower()))
    for size in (1, 7, 100):
        monkeypatch.setattr(divergence, "SLICE", size)
        assert Counter(t for terms in divergence._term_lists(text) for t in terms) == whole


def test_counts_are_handed_on_when_there_are_many(monkeypatch):
    monkeypatch.setattr(divergence, "HELD_COUNTS", 10)
    import pyarrow as pa
    rows = corpus()
    batch = pa.RecordBatch.from_pylist([{"lang": r[2], "source": r[3], "text": r[1].encode()} for r in rows])
    total = Counter()
    for part in divergence._counter(64)([batch]):
        for row in part.to_pylist():
            for source, n in zip(row["sources"], row["ns"]):
                total[row["lang"], source, row["term"]] += n
    wanted = Counter()
    for _, text, lang, source, _ in rows:
        wanted.update((lang, source, t.decode()) for terms in divergence._term_lists(text.encode()) for t in terms)
    assert +total == wanted


def test_shares_stay_exact_for_large_counts(spark):
    n = 10 ** 17 + 7
    row = spark.range(1).select(divergence.share(F.lit(n), F.lit(3 * n), F.lit(5)).alias("p")).first()
    assert row.p == 1 + divergence.SCALE * (n + 2) // (3 * n + 10)


def test_odd_rows_ties_and_groups_without_terms(spark):
    rows = odd_rows() + [(50 + n, "tie one two", "en", f"t{n % 2}", 0) for n in range(12)] + [(80, "1 2 3", "en", "digits", 0)]
    docs = documents(spark, rows, clashing=True)
    assert audited(docs) == by_counting(rows, 10, 10)
    assert audited(docs, min_docs=1, top=2) == by_counting(rows, 1, 2)


def test_empty_table(spark):
    assert audited(documents(spark, [])) == []
