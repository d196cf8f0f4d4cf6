"""Line removal against exact counts."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F
from rows import documents, odd_rows

from wareloom.llm import line_dedup
from wareloom.llm.queries import LLM_ORACLES, LLM_QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_query_matches_sql(spark):
    sql = duckdb.connect()
    sql.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    wanted = sql.execute(LLM_ORACLES["op9_line_dedup"]).fetchall()
    got = LLM_QUERIES["op9_line_dedup"](spark, SF_DIR).select("doc_id", "n_lines", "n_removed", "text").collect()
    assert sorted(map(tuple, got)) == sorted(wanted)
    assert sum(row.n_removed for row in got) > 0


def cleaned(docs, **how):
    return {r.doc_id: r.text for r in line_dedup.remove_boilerplate(docs, **how).select("row.doc_id", "text").collect()}


def test_the_first_document_keeps_the_line(spark):
    rows = [(n, f"own line of {n}\n shared by all sites \nend {n}", "en", f"s{n}", 0) for n in range(6)]
    got = cleaned(documents(spark, rows))
    assert got[0] == rows[0][1]
    assert all(got[n] == f"own line of {n}\nend {n}" for n in range(1, 6))


@pytest.mark.parametrize("sites, goes", [(4, False), (5, True), (6, True), (40, True)])
def test_threshold_is_exact(spark, sites, goes):
    rows = [(n, "shared by many sites", "en", f"s{n % sites}", 0) for n in range(80)]
    assert (cleaned(documents(spark, rows))[79] == "") is goes


def test_estimates_far_above_the_threshold(spark):
    rows = [(n, "shared by many sites\nhalf of them share this" if n % 2 else "shared by many sites", "en", f"s{n}", 0)
            for n in range(3000)]
    got = cleaned(documents(spark, rows), min_sites=2000)
    assert got[2999] == "half of them share this"


def test_one_site_and_blanks_stay(spark):
    rows = [(n, "one site\n\nthe same site again\n", "en", "one", 0) for n in range(9)]
    rows += [(n, f"own {n}\n\n \nmy{n}", "en", f"s{n}", 0) for n in range(10, 20)]
    assert cleaned(documents(spark, rows)) == {r[0]: r[1] for r in rows}


def test_lines_of_any_length_go(spark):
    rows = [(n, f"own {n}\nOK.\n漢字仮名\ntwo words", "en", f"s{n}", 0) for n in range(6)]
    got = cleaned(documents(spark, rows))
    assert got[0] == rows[0][1] and all(got[n] == f"own {n}" for n in range(1, 6))
    assert cleaned(documents(spark, rows), min_words=2)[1] == "own 1\nOK.\n漢字仮名"


def test_odd_rows_and_clashing_columns(spark):
    docs = documents(spark, odd_rows(), clashing=True)
    kept = line_dedup.clean(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.select("doc_id", "text", "row").collect())) == sorted(
        map(str, docs.select("doc_id", "text", "row").collect()))


def test_emptied_documents_go_and_lengths_follow(spark):
    rows = [(n, "shared by many sites" + (f"\nown é words {n:02}" if n % 2 else ""), "en", f"s{n}", 0) for n in range(12)]
    got = {r.doc_id: (r.text, r.n_chars) for r in line_dedup.clean(documents(spark, rows)).collect()}
    assert got == {0: ("shared by many sites", 20)} | {n: (f"own é words {n:02}", 14) for n in range(1, 12, 2)}


def test_empty_table(spark):
    assert line_dedup.clean(documents(spark, [])).count() == 0
    assert line_dedup.remove_boilerplate(documents(spark, [])).where(F.col("emptied")).count() == 0
