"""Held-out accuracy of language identification, and the models' probabilities."""

import os
import zlib
from collections import Counter

import numpy as np
import pytest
from rows import documents, odd_rows

from wareloom.llm import language
from wareloom.llm.queries import LLM_QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in LLM_QUERIES["op4_language"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows.values())
    judged = [d for d in docs if rows[d.doc_id].held_out]
    assert sum(rows[d.doc_id].lang_pred == d.lang for d in judged) >= 0.98 * len(judged)
    assert all(0 <= r.score <= 1 for r in rows.values())


def grams(text):
    codes = language.symbols(text)
    history = np.concatenate([np.zeros(language.ORDER - 1, np.uint32), codes])
    return np.unique(np.lib.stride_tricks.sliding_window_view(history, language.ORDER), axis=0, return_counts=True)


def plain(text, d=language.DISCOUNT):
    """Interpolated Kneser-Ney as the textbook has it: a function of context and character."""
    codes = (0,) * (language.ORDER - 1) + tuple(language.symbols(text).tolist())
    counts = {language.ORDER: Counter(codes[n:n + language.ORDER] for n in range(len(codes) - language.ORDER + 1))}
    for order in range(language.ORDER - 1, 0, -1):
        counts[order] = Counter(gram[1:] for gram in counts[order + 1])
    vocabulary = len(counts[1]) + 1

    def probability(context, character):
        if len(context) + 1 == 1:
            lower = 1 / vocabulary
        else:
            lower = probability(context[1:], character)
        own = {g: n for g, n in counts[len(context) + 1].items() if g[:-1] == context}
        total = sum(own.values())
        if not total:
            return lower
        return max(own.get((*context, character), 0) - d, 0) / total + d * len(own) / total * lower
    return probability


def test_probabilities_are_interpolated_kneser_ney():
    one, other = "abracadabra abraham ban banana", "la casa blanca de la abuela"
    models = language.build({"x": grams(one), "y": grams(other)})
    text = "a banal casa zebra abra"
    codes = language.symbols(text)
    history = (0,) * (language.ORDER - 1) + tuple(codes.tolist())
    for column, source in enumerate((one, other)):
        p = plain(source)
        total = sum(np.log(p(history[n:n + language.ORDER - 1], history[n + language.ORDER - 1])) for n in range(len(codes)))
        assert models.entropies(codes)[column] == pytest.approx(-total / len(codes), rel=1e-5)


def test_a_text_longer_than_a_block_scores_the_same(monkeypatch):
    models = language.build({"x": grams("abracadabra abraham ban banana")})
    codes = language.symbols("abra ban cad " * 50)
    whole = models.entropies(codes)
    monkeypatch.setattr(language, "BLOCK", 37)
    assert models.entropies(codes) == pytest.approx(whole)


def test_hash_tables_are_sorted():
    models = language.build({"x": grams("abracadabra"), "y": grams("hocus pocus")})
    for level in models.levels:
        assert (np.diff(level.grams.astype(float)) >= 0).all() and (np.sort(level.contexts) == level.contexts).all()


def test_unlike_texts_are_rejected(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    models = language.train(docs)
    odd = documents(spark, [(1, "привет как дела сегодня" * 5, None, None, 0), (2, "zqxj kvwz xxqj " * 20, None, None, 0)])
    assert all(r.rejected for r in language.identify(odd, models).collect())
    assert np.mean([r.rejected for r in language.identify(docs, models).collect()]) < 0.05


def test_held_out_documents_teach_nothing(spark):
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    changed = docs.withColumn("lang", F.when(language.held_out(), F.lit("zz")).otherwise(F.col("lang")))
    assert language.train(changed).languages == language.train(docs).languages


def test_odd_rows_and_clashing_columns(spark):
    docs = documents(spark, odd_rows(), clashing=True)
    got = language.identify(docs, language.train(docs)).collect()
    assert len(got) == docs.count()
    blank = {r.text for r in docs.collect() if not any(c.isalpha() for c in r.text or "")}
    assert sum(r.lang_pred == "und" for r in got) == sum(r.text in blank for r in docs.collect())


def test_empty_table_and_nothing_to_learn(spark):
    assert language.identify(documents(spark, []), language.train(documents(spark, []))).count() == 0
    docs = documents(spark, [(1, "some text", None, None, 0)])
    assert [r.lang_pred for r in language.identify(docs, language.train(docs)).collect()] == ["und"]
