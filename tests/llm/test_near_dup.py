"""Classes of near copies against all pairs by brute force."""

import os
import random
from collections import defaultdict

import numpy as np
from rows import documents, odd_rows, sentence

from wareloom.llm import near_dup
from wareloom.llm.queries import LLM_QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def brute(rows, least=0.8):
    """Class id of each text, by comparing all pairs that share a shingle."""
    hashes = near_dup._Hashes()
    sequences = [near_dup.labelled_shingles(text or "", hashes) for _, text in rows]
    parent = list(range(len(rows)))

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    pairs, holders = set(), defaultdict(list)
    for n, sequence in enumerate(sequences):
        for shingle in sequence.tolist():
            pairs.update((other, n) for other in holders[shingle])
            holders[shingle].append(n)
        if not len(sequence):
            pairs.update((m, n) for m in range(n) if (rows[m][1] or "") == (rows[n][1] or ""))
    for a, b in pairs:
        if not len(sequences[a]) or near_dup.compare(sequences[a], sequences[b])[0] >= least:
            parent[find(a)] = find(b)
    ids = defaultdict(list)
    for n, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[find(n)].append(doc_id)
    return [(doc_id, min(ids[find(n)], default=None)) for n, (doc_id, _) in enumerate(rows)]


def same(got, wanted):
    assert sorted(map(str, ((r.doc_id, r.class_id) for r in got))) == sorted(map(str, wanted))


def edited(text, seed, edits):
    rng, words = random.Random(seed), text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(1000)}"
    return " ".join(words)


def test_query_finds_what_brute_force_finds(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = LLM_QUERIES["op5_near_dup"](spark, SF_DIR).collect()
    same(got, brute(rows))
    assert len({r.class_id for r in got}) < len(rows)


def test_groups_of_edited_copies(spark):
    base = [sentence(n, 120) for n in range(4)]
    rows = [(n, edited(base[n % 4], n, n % 5)) for n in range(80)]
    got = near_dup.classes(documents(spark, [(*r, "en", "a", 0) for r in rows])).collect()
    same(got, brute(rows))


def test_a_chain_of_copies_is_one_class(spark):
    text, rows = sentence(5, 200), []
    for n in range(25):
        rows.append((n, text))
        text = edited(text, n, 4)
    got = near_dup.classes(documents(spark, [(*r, "en", "a", 0) for r in rows])).collect()
    same(got, brute(rows))
    assert {r.class_id for r in got} == {0}


def test_texts_that_share_most_but_not_enough(spark):
    """Buckets full of texts that fail against their hub, some of them alike among themselves."""
    shared = sentence(1, 70)
    rows = [(n, shared + " " + edited(sentence(100 + n // 2, 45), n, n % 2)) for n in range(60)]
    got = near_dup.classes(documents(spark, [(*r, "en", "a", 0) for r in rows])).collect()
    same(got, brute(rows))
    assert 1 < len({r.class_id for r in got}) < 60


def test_moved_passages_are_told_apart(spark):
    a, b, c = (sentence(n, 60) for n in (1, 2, 3))
    got = near_dup.classes(documents(spark, [(0, f"{a} {b} {c}", "", "", 0), (1, f"{c} {a} {b}", "", "", 0)])).collect()
    assert {r.class_id for r in got} == {0, 1}


def test_the_alignment_equals_the_longest_common_subsequence():
    rng = random.Random(4)
    for _ in range(60):
        left = list(range(rng.randrange(5, 40)))
        right = [x if rng.random() > 0.1 else 100 + n for n, x in enumerate(left) if rng.random() > 0.05]
        if rng.random() > 0.5 and len(right) > 3:
            right[1], right[2] = right[2], right[1]
        table = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
        for i, x in enumerate(left):
            for j, y in enumerate(right):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        best = table[-1][-1] / (len(left) + len(right) - table[-1][-1])
        aligned, shared = near_dup.compare(np.array(left, np.uint64), np.array(right, np.uint64))
        assert shared == len(set(left) & set(right))
        assert (aligned >= 0.8) == (best >= 0.8)
        assert aligned == 0 or best < 0.8 or abs(aligned - best) < 1e-12


def test_rows_under_one_id_meet_only_their_own_text(spark):
    """100 texts with a near copy each, all under one id: 200 rows stay 200, and each is read once."""
    rows = [(1, text) for n in range(100) for text in (sentence(n, 60), edited(sentence(n, 60), n, 1))]
    docs = documents(spark, [(*row, "en", "a", 0) for row in rows])
    got = near_dup.classes(docs).collect()
    assert [(r.doc_id, r.class_id) for r in got] == [(1, 1)] * 200
    sketched = near_dup.sketch(docs)
    nodes = sketched.selectExpr("node", "doc_id rep", "body rep_body")
    wanted = nodes.selectExpr("rep", "rep_body")
    assert docs.selectExpr("doc_id rep", "xxhash64(text) rep_body").join(wanted, ["rep", "rep_body"]).count() == 200
    read = near_dup.read_sequences(nodes.select("node"), nodes, docs)
    assert read.count() == read.select("node").distinct().count() == 200


def test_repeated_shingles_are_labelled():
    hashes = near_dup._Hashes()
    made = near_dup.labelled_shingles("a b " * 50, hashes)
    assert len(made) == 96 == len(set(made.tolist()))
    assert len(near_dup.labelled_shingles("one two", hashes)) == 1
    assert len(near_dup.labelled_shingles("...", hashes)) == 0


def test_odd_rows_and_clashing_columns(spark):
    docs = documents(spark, odd_rows(), clashing=True)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    same(near_dup.classes(docs).collect(), brute(rows))
    kept = near_dup.keep_one(docs)
    assert kept.columns == docs.columns
    # 2 copies 1; 4 has a text of its own besides the empty one of 3; rows without an id stay.
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        map(str, [1, 3, 4, 4, 4, None, None, 7, 8, 9, 10, 11]))


def test_empty_table(spark):
    assert near_dup.classes(documents(spark, [])).count() == 0
    assert near_dup.keep_one(documents(spark, [])).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(n, n + 1) for n in range(40)] + [(100, 101)], "left long, right long")
    got = {r.node: r.label for r in near_dup.components(edges).collect()}
    assert got == {n: 0 for n in range(41)} | {100: 100, 101: 100}
