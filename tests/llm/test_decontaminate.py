"""Contamination against all windows by brute force."""

import os
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from rows import documents, odd_rows, sentence

from wareloom.llm import decontaminate
from wareloom.llm.queries import LLM_QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def shingles(words):
    return [tuple(words[n:n + 5]) for n in range(max(len(words) - 4, 1))] if words else []


def alike(a, b):
    a, b = Counter(a), Counter(b)
    shared = sum((a & b).values())
    return shared / (a.total() + b.total() - shared)


def brute(docs, items, least=0.8):
    found = {}
    for item_id, item in items:
        wanted = shingles(re.findall(r"[^\W_]+", (item or "").lower()))
        known = set(wanted)
        for doc_id, text in docs:
            doc = shingles(re.findall(r"[^\W_]+", (text or "").lower()))
            if not wanted or not known & set(doc):
                continue
            best = max(alike(doc[n:n + len(wanted)], wanted) for n in range(max(len(doc) - len(wanted), 0) + 1))
            if best >= least:
                found[doc_id, item_id] = best
    return found


def held(docs, benchmark):
    rows = decontaminate.contaminated(docs, benchmark).collect()
    assert len({(r.doc_id, r.item_id) for r in rows}) == len(rows)
    return {(r.doc_id, r.item_id): r.similarity for r in rows}


def items(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_query_finds_what_brute_force_finds(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    listed = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r.doc_id, r.item_id): r.similarity for r in LLM_QUERIES["op10_decontaminate"](spark, SF_DIR).collect()}
    assert got == pytest.approx(brute(docs, listed))
    assert got


def test_edited_passages(spark):
    item = sentence(1, 60, "i").split()
    texts = []
    for n in range(40):
        words = list(item)
        if n % 4 == 1:
            words[n] = "changed"
        elif n % 4 == 2:
            del words[n]
        elif n % 4 == 3:
            words.insert(n, "added")
        texts.append(sentence(n + 50, n) + " " + " ".join(words) + " " + sentence(n + 100, 40 - n))
    wanted = brute(list(enumerate(texts)), [(0, " ".join(item))])
    got = held(documents(spark, [(n, t, "en", "a", 0) for n, t in enumerate(texts)]), items(spark, " ".join(item)))
    assert set(got) == set(wanted) and len(wanted) >= 30


def test_moved_parts_and_short_items(spark):
    """The item's end stands before its beginning; an item of three words stands in long texts."""
    item = sentence(1, 100, "i").split()
    doc = sentence(2, 150) + " " + " ".join(item[70:] + item[:70]) + " " + sentence(3, 150)
    again = " ".join(["x"] * 60 + item[:9] * 3 + item)
    benchmark = items(spark, " ".join(item), "three short words", "one", "x x x x x x x x y")
    docs = documents(spark, [
        (0, doc, "en", "a", 0), (1, sentence(4, 80) + " Three short, words " + sentence(5, 9), "en", "a", 0),
        (2, "three short other words", "en", "a", 0), (3, "one", "en", "a", 0), (4, "short words three", "en", "a", 0),
        (5, again, "en", "a", 0), (None, "null id has three short words", "en", "a", 0), (6, " ".join(item[3:]), "en", "a", 0)])
    got = held(docs, benchmark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    wanted = brute(rows, [(0, " ".join(item)), (3, "x x x x x x x x y")])
    assert wanted[0, 0] > 0.9
    assert got == pytest.approx(wanted | {(1, 1): 1.0, (None, 1): 1.0, (3, 2): 1.0})


def test_shuffled_and_broadcast_windows_agree(spark):
    docs = documents(spark, [(n, sentence(n, 50) + " " + sentence(999 + n % 3, 20), "en", "a", 0) for n in range(20)])
    listed = decontaminate.fingerprinted_items(items(spark, *(sentence(999 + n, 20) for n in range(3))))
    small, large = (decontaminate.windows(docs, listed, small=x).distinct().collect() for x in (True, False))
    assert set(map(str, small)) <= set(map(str, large))
    assert small


def test_odd_rows_short_items_and_clashing_columns(spark):
    docs = documents(spark, odd_rows() + [(20, "only four words here", "en", "a", 0)], clashing=True)
    benchmark = items(spark, None, "", "!!", "Only FOUR, words here!", sentence(1, 60), sentence(1, 60))
    got = held(docs, benchmark)
    assert got == {(20, 3): 1.0, (1, 4): 1.0, (2, 4): 1.0, (None, 4): 1.0, (1, 5): 1.0, (2, 5): 1.0, (None, 5): 1.0}
    kept = decontaminate.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert ids - {None} == {3, 4, 7, 8, 9, 10, 11}
    # Rows without an id go by their text like others.
    assert not {r.text for r in kept.collect()} & {sentence(1, 60)}


def test_rows_that_share_an_id_go_by_their_own_text(spark):
    docs = documents(spark, [(1, sentence(1, 60), "en", "a", 0), (1, sentence(2, 60), "en", "a", 0), (None, sentence(1, 60), "en", "a", 0),
                             (None, None, "en", "a", 0), (None, sentence(3, 60), "en", "a", 0)])
    kept = decontaminate.decontaminate(docs, items(spark, sentence(1, 60))).collect()
    assert sorted(str((r.doc_id, r.text)) for r in kept) == sorted(map(str, [(1, sentence(2, 60)), (None, None), (None, sentence(3, 60))]))


def test_empty_tables(spark):
    assert held(documents(spark, []), items(spark, sentence(1, 30))) == {}
    assert held(documents(spark, odd_rows()), items(spark).limit(0)) == {}


def test_blocks_find_every_fingerprint_within_the_radius():
    edges = decontaminate._blocks(decontaminate.RADIUS)
    assert len(edges) == decontaminate.RADIUS + 1
    covered = [low + bit for low, mask in edges for bit in range(mask.bit_length())]
    assert covered == list(range(64))


def test_items_meet_only_documents_that_hold_what_is_rare_in_them(spark):
    """300 items of one length that share half of their words, one of them in each document."""
    common = sentence(7, 30)
    texts = [common + " " + sentence(1000 + n, 30) for n in range(300)]
    docs = documents(spark, [(n, sentence(5000 + n, 40) + " " + texts[n % 300] + " " + sentence(6000 + n, 40), "en", "a", 0)
                             for n in range(200)])
    benchmark = items(spark, *texts)
    listed = decontaminate.fingerprinted_items(benchmark)
    seen = decontaminate.windows(docs, listed).withColumn("place", F.struct("doc_id", "key"))
    for small in (True, False):
        met = decontaminate.candidates(seen, decontaminate.rare_shingles(listed), small)
        assert 200 <= met.count() <= 200 * 300 // 10
    assert {k: v for k, v in held(docs, benchmark).items() if v == 1} == {(n, n): 1.0 for n in range(200)}


def test_equal_items_and_repeated_rows(spark):
    docs = documents(spark, [(1, sentence(1, 60), "en", "a", 0)] * 50 + [(None, sentence(1, 60), "en", "a", 0)] * 50)
    found = decontaminate.alike_windows(docs, items(spark, *[sentence(1, 60)] * 20))
    assert found.count() == 100 * 20
    assert held(docs, items(spark, *[sentence(1, 60)] * 3)) == {(d, n): 1.0 for d in (1, None) for n in range(3)}
