"""Base spans against the plain patterns, disclosures against plain counts."""

import hashlib
import math
import os
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from rows import documents, odd_rows, texts

from wareloom.llm import pii
from wareloom.llm.queries import LLM_QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + n % 2) for n, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in value.split(".")),
            "card": lambda: 14 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 10 <= len(digits) <= 15}[kind]()


def base(text):
    found = [(m.start(), n, m.end(), kind) for n, (kind, pattern) in enumerate(PLAIN.items())
             for m in re.finditer(pattern, text or "") if valid(kind, m[0])]
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found))


def test_query_keeps_all_base_spans(spark):
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = LLM_QUERIES["op2_pii"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(given)
    for row in rows:
        wanted = base(given[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(wanted.encode()).hexdigest()
        kinds = [span.split(":")[0] for span in wanted.split(",")]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [kinds.count(kind) for kind in PLAIN]
        spans = [span for span in row.spans.split(",") if span]
        assert ",".join(s for s in spans if s.split(":")[0] in PLAIN) == wanted
        places = [(int(s.split(":")[1]), pii.KINDS.index(s.split(":")[0])) for s in spans]
        assert places == sorted(places)


HARD = [
    "a@b.cc_x@d.e+1 (555) 123-4567 1.2.3.4.5.6.7.8 256.1.1.1 4111 1111 1111 1111 é4111-1111-1111-1111é +49 30 123456789 ",
    "😀 a.b@c.de 😀 10.0.0.1", "4111111111111111 " * 30, "x@y..z a@b.c. +12345678901. %@a.b@c.d @@a@b-.c",
    "0255.00.000000000001.9 1.2.3.999 1.2.3.4.", "+1(((2345678901 +1 234 +123456789012345678", "a@b" + ".c" * 3000, "1.2." * 2000,
]


def test_hard_base_cases(spark):
    got = pii.protect(texts(spark, *HARD)).select("doc_id", pii.as_text("base").alias("base")).collect()
    assert {r.doc_id: r.base for r in got} == {n: base(text) for n, text in enumerate(HARD)}


def test_long_runs_stay_linear(spark):
    runs = ["a" * 300_000 + "@", "1" * 300_000, "+1" + "(" * 300_000, "1." * 150_000 + "@", "." * 300_000]
    got = pii.protect(texts(spark, *runs)).select(pii.as_text("base").alias("base")).collect()
    assert len(got) == len(runs)


def test_terms_are_marked_by_what_they_disclose(spark):
    """'secretname' only stands by one address, 'rather' stands by it and elsewhere, 'common' is everywhere."""
    rows = ["common secretname rather jo@x.org common"] * 3
    rows += [f"common secretname rather jo@x.org number{n}" for n in range(2)]
    rows += [f"common rather filler{n}" for n in range(3)] + [f"common words{n} only" for n in range(40)]
    docs = texts(spark, *rows)
    found = pii.mentions(docs)
    got = {(r.entity, r.term): r.disclosure for r in pii.disclosures(docs, found, pii.neighbours(found)).collect()}
    total, entity = len(rows), 5
    information = math.log(total / entity)
    holding = defaultdict(int)
    for text in rows:
        for term in set(re.findall("[a-z]{3,}", text)):
            holding[term] += 1
    for term in ("secretname", "rather", "common"):
        assert got["email:jo@x.org", term] == pytest.approx(math.log(total * 5 / (entity * holding[term])) / information)
    spans = {r.doc_id: r.spans for r in pii.protect(docs).select("doc_id", pii.as_text("spans").alias("spans")).collect()}
    assert spans[0] == "remove:7:17,generalise:18:24,email:25:33"
    assert spans[10] == ""
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert clean[0] == "common  [TERM] [EMAIL] common"
    assert clean[20] == rows[20]


def test_far_and_repeated_terms_are_marked(spark):
    """'farname' stands with the address in all its documents, but far off and more than once."""
    filler = "common words here " * 20
    rows = [f"Farname {filler}jo@x.org {filler}farname" for _ in range(4)] + [f"common words here {n}" for n in range(40)]
    spans = {r.doc_id: r.spans for r in pii.protect(texts(spark, *rows)).select("doc_id", pii.as_text("spans").alias("spans")).collect()}
    mail, last = rows[0].index("jo@"), rows[0].rindex("farname")
    assert {spans[n] for n in range(4)} == {f"remove:0:7,email:{mail}:{mail + 8},remove:{last}:{last + 7}"}
    assert {spans[n] for n in range(4, 44)} == {""}


def marked_by_brute_force(rows):
    """``(place, kind, stop)`` of the terms that ``rows`` of id and text reveal, each different row once."""
    once = {(doc, text) for doc, text in rows}
    words = {row: set(re.findall(r"[a-z]{3,}", row[1].lower())) for row in once}
    mails = {row: set(re.findall(r"[a-z]+@x\.org", row[1])) for row in once}
    found = {}
    for row in once:
        for match in re.finditer(r"[a-z]{3,}", row[1].lower()):
            best = 0.0
            for mail in mails[row]:
                entity = sum(mail in mails[other] for other in once)
                term = sum(match[0] in words[other] for other in once)
                both = sum(mail in mails[other] and match[0] in words[other] for other in once)
                if both >= pii.SUPPORT and entity < len(once):
                    best = max(best, math.log(len(once) * both / (entity * term)) / math.log(len(once) / entity))
            inside = any(m.start() < match.end() and match.start() < m.end() for m in re.finditer(r"[a-z]+@x\.org", row[1]))
            if best >= pii.GENERALISE and not inside:
                found.setdefault(row, []).append(("remove" if best >= pii.REMOVE else "generalise", match.start(), match.end()))
    return found


@pytest.mark.parametrize("times", [1, 20])
def test_spans_equal_brute_force_also_with_repeated_rows(spark, times):
    draw = random.Random(5)
    vocabulary = ["".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(40)]
    rows = []
    for n in range(60):
        text = draw.choices(vocabulary, k=8)
        # People with words of their own, two of whom are always named together.
        for who in draw.sample(["ann", "bob", "cid", "dee"], draw.choice([0, 0, 1, 2])):
            text += [f"{who}@x.org", vocabulary["abcd".index(who[0])], *(["eve@x.org"] if who == "ann" else [])]
        draw.shuffle(text)
        rows.append((n // 2 if n < 50 else None, " ".join(text)))
    wanted = marked_by_brute_force(rows)
    docs = spark.createDataFrame(rows * times, "doc_id long, text string")
    got = pii.protect(docs).groupBy("doc_id", "key", pii.as_text("spans").alias("spans")).count().join(
        docs.select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("k"), "text").distinct(),
        F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k"))).collect()
    assert sum(r["count"] for r in got) == len(rows) * times
    assert sum(map(len, wanted.values())) > 20
    for row in got:
        marks = [tuple(span.split(":")) for span in row.spans.split(",") if span and not span.startswith("email")]
        assert [(k, int(a), int(b)) for k, a, b in marks] == wanted.get((row.doc_id, row.text), [])


def test_terms_cut_by_the_window_are_left_out(spark):
    far = "farterm " + "x" * 58 + " jo@x.org " + "y" * 60 + " cutoffterm"
    docs = texts(spark, far)
    terms = {r.term: (r.start, r.stop) for r in pii.neighbours(pii.mentions(docs)).collect()}
    assert terms == {"x" * 58: (8, 66), "y" * 60: (76, 136)}


def test_odd_rows_and_clashing_columns(spark):
    docs = documents(spark, odd_rows() + [(20, HARD[0], "en", "a", 0)] * 2, clashing=True)
    got = pii.protect(docs).select("doc_id", pii.as_text("base").alias("base")).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(str((r.doc_id, base(r.text))) for r in docs.collect())
    assert pii.sanitise(docs).count() == docs.count()


def test_empty_table(spark):
    assert pii.protect(documents(spark, [])).count() == 0
