"""Repeated byte strings against counting every window, and merged transforms against sorting."""

import hashlib
import os
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from rows import documents, odd_rows, texts

from wareloom.llm import bwt, repeats
from wareloom.llm.queries import LLM_QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def by_counting(bodies, window):
    """Removed spans of each text, from the count of every window."""
    seen = Counter(b[n:n + window] for b in bodies for n in range(len(b) - window + 1))
    found = []
    for b in bodies:
        gone = bytearray(len(b))
        for n in range(len(b) - window + 1):
            if seen[b[n:n + window]] > 1:
                gone[n:n + window] = b"\1" * window
        edges = np.flatnonzero(np.diff(np.frombuffer(b"\0" + bytes(gone) + b"\0", dtype=np.uint8).astype(int)))
        found.append(list(zip(edges[::2].tolist(), edges[1::2].tolist())))
    return found


def removed(docs, **how):
    rows = repeats.remove_repeats(docs, **how).collect()
    return sorted((r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in rows)


def wanted(rows, window):
    bodies = [(r[1] or "").encode() for r in rows]
    found = []
    for body, spans in zip(bodies, by_counting(bodies, window)):
        kept, at = b"", 0
        for a, b in spans:
            kept, at = kept + body[at:a], b
        found.append((len(body), spans, kept + body[at:]))
    return sorted(found)


def passages(seed, docs, alphabet="abcdeé漢 "):
    """Texts put together from shared passages and own text."""
    rng = random.Random(seed)
    own = lambda n: "".join(rng.choices(alphabet, k=n))
    shared = [own(rng.randrange(5, 90)) for _ in range(8)]
    rows = []
    for n in range(docs):
        body = "".join(rng.choice(shared) if rng.random() < 0.5 else own(rng.randrange(40)) for _ in range(rng.randrange(8)))
        rows.append((n, body, "en", "s", 0))
    rows += rng.sample(rows, docs // 8) + [(docs + 1, "ab" * 300, "en", "s", 0), (docs + 2, "x" * 500, "en", "s", 0)]
    return rows


def test_query_equals_counting(spark):
    docs = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF_DIR}/documents.parquet'").fetchall()
    bodies = [text.encode() for _, text in docs]
    expected = []
    for (doc_id, _), body, spans in zip(docs, bodies, by_counting(bodies, repeats.WINDOW)):
        cut, at = b"", 0
        for a, b in spans:
            cut, at = cut + body[at:a], b
        cut += body[at:]
        expected.append((doc_id, len(body), len(body) - len(cut), len(spans), hashlib.sha256(cut).hexdigest()))
    got = LLM_QUERIES["op13_repeats"](spark, SF_DIR).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(expected)
    assert sum(row.n_removed for row in got) > 0


@pytest.mark.parametrize("how", [
    dict(window=24, grams=(6, 20, 24)),
    dict(window=24, grams=(6, 20, 24), max_kinds=1),
    dict(window=17, grams=(3, 17), max_kinds=2),
    dict(window=8, grams=(8,)),
])
def test_equals_counting(spark, how):
    rows = passages(len(str(how)), 40)
    assert removed(documents(spark, rows), **how) == wanted(rows, how["window"])


def test_bins_and_shards(spark, monkeypatch):
    """Many small parts give the same."""
    rows = passages(2, 40)
    for name, value in {"BIN_BYTES": 300, "SHARD_BYTES": 100}.items():
        monkeypatch.setattr(repeats, name, value)
    assert removed(documents(spark, rows), window=20, grams=(5, 16, 20)) == wanted(rows, 20)


def test_long_texts_are_cut_in_blocks(monkeypatch):
    import pyarrow as pa
    rng = random.Random(4)
    text = bytes(rng.choices(b"abc", k=900))
    batch = pa.RecordBatch.from_pylist([{"n": 1, "text": text}, {"n": 2, "text": b"short"}, {"n": 3, "text": text[:50]}])
    for block in (30, 97, 1 << 20):
        monkeypatch.setattr(repeats, "BLOCK", block)
        windows = Counter()
        for part in repeats._cutter(24, 6, ["n"])([batch]):
            for row in part.to_pylist():
                windows.update((row["n"], row["start"] + k) for k in range(row["windows"]))
        assert windows == Counter([(1, k) for k in range(877)] + [(3, k) for k in range(27)])


def test_equal_windows_have_equal_keys():
    rng = random.Random(5)
    shared = bytes(rng.choices(range(256), k=60))
    keys = {}
    for _ in range(20):
        data = bytes(rng.choices(range(256), k=rng.randrange(50))) + shared + bytes(rng.choices(range(256), k=30))
        _, key, start, windows, _, _ = repeats.cut([data], 24, 6)
        for k, s, n in zip(key.tolist(), start.tolist(), windows.tolist()):
            for at in range(s, s + n):
                assert keys.setdefault(data[at:at + 24], k) == k


@pytest.mark.parametrize("depth", [1, 2, 3, 7, 16, 21])
def test_merged_blocks_equal_sorting(depth):
    rng = random.Random(depth)
    strings = [bytes(rng.choices(b"ab", k=rng.randrange(depth, 40))) for _ in range(30)]
    cuts = [strings[:7], strings[7:8], strings[8:]]
    shards = [(bwt.transform(part), len(part)) for part in cuts]
    blocks = bwt.interleave(shards, depth)
    by_block = {}
    for part, (transformed, count), block in zip(cuts, shards, blocks):
        rows = bwt.starts(transformed, count, 40)
        for n, string in enumerate(part):
            for at in range(len(string) - depth + 1):
                by_block.setdefault(int(block[rows[n, at]]), set()).add(string[at:at + depth])
    # One prefix to a block, and blocks in the order of their prefixes.
    assert all(len(found) == 1 for found in by_block.values())
    prefixes = [by_block[b].pop() for b in sorted(by_block)]
    assert prefixes == sorted(set(prefixes))


def test_transform_equals_sorting():
    strings = [b"banana", b"", b"ana\0\xff", b"banana"]
    ranked = sorted(((s[n:], t), s, n) for t, s in enumerate(strings) for n in range(len(s) + 1))
    key = lambda s, t: [len(strings) + c for c in s] + [t]
    ranked = sorted(((key(s[n:], t), s, n, t) for t, s in enumerate(strings) for n in range(len(s) + 1)), key=lambda r: r[0])
    assert bwt.transform(strings).tolist() == [len(strings) + s[n - 1] if n else t for _, s, n, t in ranked]


@pytest.mark.parametrize("bound", [40, 1 << 20, 1 << 60])
def test_ranks_equal_sorting(bound):
    """Keys are ranked alike whether or not their places fit beside them."""
    rng = random.Random(bound)
    for size in (1, 2, 3, 50):
        keys = np.array([rng.choice((0, bound - 1, rng.randrange(bound))) for _ in range(size)], dtype=np.int64)
        ranks, kinds = bwt._ranks(keys, bound)
        assert ranks.tolist() == [sorted(set(keys.tolist())).index(key) for key in keys.tolist()] and kinds == len(set(keys.tolist()))


@pytest.mark.parametrize("strings", [[b""], [b"", b"a"], [b"ab" * 40, b"b" * 9] + [b"a"] * 40])
def test_transform_of_few_and_many_strings(strings):
    of = lambda s, t, n: [len(strings) + c for c in s[n:]] + [t]
    ranked = sorted((of(s, t, n), s, n, t) for t, s in enumerate(strings) for n in range(len(s) + 1))
    assert bwt.transform(strings).tolist() == [len(strings) + s[n - 1] if n else t for _, s, n, t in ranked]


def test_odd_rows_and_clashing_columns(spark):
    rows = odd_rows()
    docs = documents(spark, rows, clashing=True)
    got = repeats.remove_repeats(docs, window=100, grams=(20, 90, 100))
    assert sorted((r.n_bytes, len(bytes(r.kept))) for r in got.collect()) == sorted((a, len(c)) for a, _, c in wanted(rows, 100))


def test_rows_repeated_with_and_without_an_id(spark):
    body = " ".join(f"word{n}" for n in range(100))
    for ids in ([7, 7], [None, None], [7, None], [7, 8]):
        got = repeats.remove_repeats(documents(spark, [(i, body, "en", "s", 0) for i in ids])).collect()
        assert [(r.doc_id, len(r.spans), bytes(r.kept)) for r in sorted(got, key=str, reverse=True)] and len(got) == 2
        assert all(bytes(r.kept) == b"" for r in got)
    (alone,) = repeats.remove_repeats(documents(spark, [(7, body, "en", "s", 0)])).collect()
    assert bytes(alone.kept).decode() == body


def test_length_of_a_window_decides(spark):
    own = lambda n: "".join(random.Random(n).choices("abcdefgh", k=450))
    for size, goes in ((399, 0), (400, 400), (401, 401)):
        shared = "".join(random.Random(0).choices("xyz", k=size))
        got = repeats.remove_repeats(texts(spark, own(1) + shared + own(2), own(3) + shared + own(4))).collect()
        assert [sum(s["until"] - s["from"] for s in r.spans) for r in got] == [goes, goes]


def test_a_text_that_repeats_itself(spark):
    """Equal windows may overlap, also where no other text has them."""
    own = lambda n: "".join(random.Random(n).choices("abcdefgh", k=300))
    for body, spans in ((own(1) + "xyz" * 135 + own(2), [(300, 705)]), (own(1) + "xyz" * 134 + own(2), []),
                        ("q" * 401, [(0, 401)]), ("q" * 400, [])):
        (row,) = repeats.remove_repeats(texts(spark, body)).collect()
        assert [tuple(s) for s in row.spans] == spans


def test_a_frequent_passage_is_cut_again(spark):
    """Passages that all documents share, in surroundings of their own, meet in no single bin."""
    own = lambda n: "".join(random.Random(n).choices("abcdefgh", k=300))
    for size in (380, 500):
        passage = "".join(random.Random(0).choices("xyz", k=size))
        rows = [(n, own(2 * n) + passage + own(2 * n + 1), "en", "s", 0) for n in range(60)]
        assert removed(documents(spark, rows), max_kinds=10) == wanted(rows, repeats.WINDOW)


def test_passages_of_fifty_words_are_counted(spark):
    """A passage with less bytes than the window stays, but both of its documents tell of it."""
    own = lambda n, words: " ".join("".join(random.Random(n * 1000 + k).choices("abcdefgh", k=6)) for k in range(words))
    shared = lambda n, words: " ".join("".join(random.Random(-n * 1000 - k).choices("xyzw", k=5)) for k in range(1, words + 1))
    bodies = [f"{own(1, 70)} {shared(1, 50)} {own(2, 70)}", f"{own(3, 9)}\n{shared(1, 50)}\t{own(4, 80)}",
              f"{own(5, 60)} {shared(2, 31)} {own(6, 60)}", f"{own(7, 60)} {shared(2, 31)} {own(8, 60)}",
              f"{own(9, 20)} {shared(3, 55)} {own(10, 20)} {shared(3, 55)} {own(11, 5)}", own(12, 300), shared(4, 49), shared(4, 49), ""]
    rows = sorted(repeats.remove_repeats(texts(spark, *bodies)).collect(), key=lambda r: r.doc_id)
    assert all(len(r.spans) == 0 and bytes(r.kept).decode() == body for r, body in zip(rows, bodies))
    assert [r.n_shared_marks > 0 for r in rows] == [True, True, *[False] * 7]


def test_shared_marks_against_all_passages(spark):
    rng = random.Random(6)
    rows = [(n, " ".join(rng.choices("abcd", k=rng.randrange(40))), "en", "s", 0) for n in range(30)]
    rows += [(30, None, "en", "s", 0), (None, rows[3][1], "en", "s", 0), (7, rows[7][1], "en", "s", 0)]
    runs = lambda body, k: {tuple(words[n:n + k]) for words in [(body or "").split()] for n in range(len(words) - k + 1)}
    for passage, mark in ((7, 4), (5, 5), (9, 8)):
        got = {(r.doc_id, r.body): r.n for r in repeats.shared_marks(documents(spark, rows), passage, mark).collect()}
        bodied = repeats._bodies(documents(spark, rows)).collect()
        assert got.keys() <= {(r.doc_id, r.body) for r in bodied} and all(n > 0 for n in got.values())
        for at, row in enumerate(bodied):
            others = [bytes(other.text).decode() for n, other in enumerate(bodied) if n != at]
            body = bytes(row.text).decode()
            n = got.get((row.doc_id, row.body), 0)
            if any(runs(body, passage) & runs(other, passage) for other in others):
                assert n > 0
            assert n <= len({run for other in others for run in runs(body, mark) & runs(other, mark)})


def test_marks_of_long_texts_are_taken_in_blocks(monkeypatch):
    import pyarrow as pa
    rng = random.Random(7)
    long = " ".join(str(rng.randrange(1000)) for _ in range(400)) + " " + "x" * 300 + " \n " + " ".join(str(rng.randrange(1000)) for _ in range(90))
    batch = pa.RecordBatch.from_pylist([{"doc_id": n, "body": n, "text": t} for n, t in enumerate([long.encode(), b"short", long[:900].encode()])])
    found = []
    for block in (70, 200, 1 << 20):
        monkeypatch.setattr(repeats, "BLOCK", block)
        rows = [(r["doc_id"], r["mark"]) for part in repeats._marker(12, 7)([batch]) for r in part.to_pylist()]
        assert len(rows) == len(set(rows))
        found.append(set(rows))
    assert found[0] == found[1] == found[2] and {n for n, _ in found[0]} == {0, 2}


def test_empty_table(spark):
    assert repeats.remove_repeats(documents(spark, [])).count() == 0
    assert repeats.repeated_spans(documents(spark, []).where(F.lit(True))).count() == 0
