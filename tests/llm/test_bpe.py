"""Ids against the tiktoken library on whole texts, and the round trip."""

import random

import public_tokenizers
import pytest
from rows import documents, odd_rows

from wareloom.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
PATTERN = public_tokenizers.PATTERN


def whole(text):
    return bpe._encoding(RANKS, PATTERN).encode_to_numpy(text or "").astype("<u4").tobytes()


def check(docs, **sizes):
    decoded = bpe.decode(bpe.encode(docs, RANKS, PATTERN, **sizes), RANKS, PATTERN).collect()
    given = docs.collect()
    got = sorted((str(r.doc_id), bytes(r.ids), bytes(r.decoded), r.n_tokens) for r in decoded)
    assert got == sorted(
        (str(r.doc_id), whole(r.text), (r.text or "").encode(), len(whole(r.text)) // 4) for r in given)


def test_odd_rows_and_clashing_columns(spark):
    check(documents(spark, odd_rows(), clashing=True))


def test_empty_table(spark):
    check(documents(spark, []))


@pytest.mark.parametrize("chunk, overlap", [(64, 24), (40, 16), (200, 150)])
def test_chunks_of_any_size_give_the_same_ids(spark, chunk, overlap):
    rng = random.Random(chunk)
    texts = [
        "".join(rng.choice(letters) for _ in range(rng.randrange(900)))
        for letters in ("ab'ls \n\n1é.,漢😀", "aaaaaaaaaab ", " \n\t", "'sll ve", "12 3.") for _ in range(25)]
    texts += ["a" * 3000, " " * 2000 + "x" + "\n" * 300, "x" * 300 + "  \n\n y' ll 'll" * 80, "don't  we'll\n\n\n" * 50]
    check(documents(spark, [(n % 40, text, "en", "a", 0) for n, text in enumerate(texts + texts[:30])]),
          chunk=chunk, overlap=overlap)


def test_a_boundary_never_parts_white_space_from_what_follows(spark):
    import regex
    head, tail = bpe.boundaries(regex.compile(PATTERN), "ab \n\n cd  ef", 4, 8, False, False)
    assert all(end == 0 or not "ab \n\n cd  ef"[end - 1].isspace() for end in head + tail)
