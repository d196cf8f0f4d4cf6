"""The pipeline's stages one by one against plain decisions, and the whole run."""

import hashlib
import os

import corpus_pipeline
import public_tokenizers
from rows import documents, odd_rows

from wareloom.llm import bpe, near_dup, quality
from wareloom.session import stage

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_every_stage_works_on_what_the_one_before_kept(spark):
    from test_decontaminate import brute as held
    from test_near_dup import brute as copies
    docs = stage(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dup", "decontaminate", "tokens"]
    steps = dict(corpus_pipeline.STAGES)

    good = stage(steps["quality"](spark, docs, SF_DIR))
    assert good.columns == columns
    scores = quality.classify(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet")).collect()
    assert sorted(r.doc_id for r in good.collect()) == sorted(r.doc_id for r in scores if r.predicted)

    lines = stage(steps["line_dedup"](spark, good, SF_DIR))
    assert lines.columns == columns
    sites, first = {}, {}
    for r in sorted(good.collect()):
        for line in set(r.text.split("\n")):
            line = line.strip(" \t\r")
            if line:
                sites.setdefault(line, set()).add(r.source)
                first.setdefault(line, r.doc_id)
    gone = {line for line, own in sites.items() if len(own) >= 5}
    wanted = {}
    for r in good.collect():
        kept = [x for x in r.text.split("\n") if x.strip(" \t\r") not in gone or first[x.strip(" \t\r")] == r.doc_id]
        if len(kept) == len(r.text.split("\n")) or "".join(kept).strip():
            wanted[r.doc_id] = "\n".join(kept)
    assert {r.doc_id: r.text for r in lines.collect()} == wanted
    assert all(r.n_chars == len(r.text) for r in lines.collect())

    single = stage(steps["near_dup"](spark, lines, SF_DIR))
    assert single.columns == columns
    classes = copies([(r.doc_id, r.text) for r in lines.collect()])
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, c in classes if i == c)

    clean = stage(steps["decontaminate"](spark, single, SF_DIR))
    assert clean.columns == columns
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {doc_id for doc_id, _ in held([(r.doc_id, r.text) for r in single.collect()], items)}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in single.collect() if r.doc_id not in bad)

    encoding = bpe._encoding(bpe.read_ranks(public_tokenizers.path(corpus_pipeline.TOKENIZER)), public_tokenizers.PATTERN)
    tokens = {r.doc_id: r for r in steps["tokens"](spark, clean, SF_DIR).collect()}
    assert set(tokens) == {r.doc_id for r in clean.collect()}
    for r in clean.collect():
        ids = encoding.encode_to_numpy(r.text).astype("<u4").tobytes()
        assert bytes(tokens[r.doc_id].ids) == ids
        assert tokens[r.doc_id].ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert tokens[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()

    whole = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert whole == {doc_id: r.ids_sha256 for doc_id, r in tokens.items()}


def test_stages_take_odd_rows_and_extra_columns(spark):
    docs = documents(spark, odd_rows(), clashing=True)
    for name, step in corpus_pipeline.STAGES[:-1]:
        after = stage(step(spark, docs, SF_DIR))
        assert after.columns == docs.columns, name
        docs = after
    assert near_dup.classes(docs).count() == docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() == docs.count()


def test_stages_take_an_empty_table(spark):
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, documents(spark, []), SF_DIR).count() == 0, name
