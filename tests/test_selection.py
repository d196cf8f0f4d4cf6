"""Harmonising, scoring, ranking, merging and saving on small frames."""

import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from wareloom import schemas, session
from wareloom.operators import align, contract, counters, keyed, ranking, scoring, sinks
from wareloom.plans import registry, selection
from wareloom.sources import testtables

STRUCTURED = "product_url string, title string, vendor string, price double, availability string, description string, " \
             "category string, store_name string, ordinal long"
SCRAPED = "product_url string, title string, price string, tag string, sku string, category string, ordinal long"


def structured(spark, *rows):
    full = [(u, t, "v", p, a, "<b>d</b>", "c", s, n) for n, (u, t, p, a, s) in enumerate(rows)]
    return spark.createDataFrame(full, STRUCTURED)


def scraped(spark, *rows):
    return spark.createDataFrame([(u, t, p, None, "s", "c", n) for n, (u, t, p) in enumerate(rows)], SCRAPED)


def scored(spark, *rows):
    """Rows ``(store, platform, priority, ordinal, url, score)``."""
    frame = spark.createDataFrame(
        rows, "source_store_name string, source_platform string, source_priority int, ordinal long, product_url string, "
              "final_score double")
    return frame.withColumns({
        "title": F.col("product_url"), "price": F.lit(1.0), "is_available_numeric": F.lit(1)})


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_structured_source_wins_and_nulls_collapse(spark):
    one = structured(spark, ("u1", "t", 10.0, "Available", "s"), (None, "n1", 1.0, "", "s"), (None, "n2", 2.0, "", "s"),
                     ("u2", None, 3.0, "", "s"), ("u3", "t", None, "", "s"))
    two = scraped(spark, ("u1", "x", "$5"), ("u4", "y", "N/A"), ("u5", "z", "$1,000.50"))
    rows = {r.product_url: r for r in selection.harmonise(one, two).collect()}
    assert {u: (r.title, r.price) for u, r in rows.items()} == {
        "u1": ("t", 10.0), None: ("n1", 1.0), "u4": ("y", None), "u5": ("z", 1000.5)}
    assert rows["u5"].source_store_name == rows["u5"].vendor == schemas.SCRAPED_STORE
    assert selection.harmonise(one, two).columns == [*schemas.CATALOGUE_COLUMNS, *schemas.ORDER_COLUMNS]


def test_first_row_wins_even_if_its_price_is_unusable(spark):
    two = scraped(spark, ("u", "a", "N/A"), ("u", "b", "$5"))
    assert selection.preprocess(selection.harmonise(None, two)).count() == 0


def test_preprocess(spark):
    rows = selection.preprocess(selection.harmonise(
        structured(spark, ("u1", "t", 10.0, "AVAILABLE", None)), scraped(spark, ("u2", "x", "5"), ("u3", "y", "-")))).collect()
    got = {r.product_url: (r.is_available_numeric, r.description_text, r.source_store_name, r.product_tags, r.sku) for r in rows}
    assert got == {"u1": (1, "d", "N/A", "N/A", "N/A"), "u2": (1, "", schemas.SCRAPED_STORE, "N/A", "s")}


def test_one_source_only(spark):
    one = structured(spark, ("u1", "t", 10.0, "Available", "s"))
    assert selection.scored_catalogue(one, None).first().final_score == pytest.approx(0.8)
    assert selection.scored_catalogue(None, scraped(spark, ("u", "t", "3"))).count() == 1
    with pytest.raises(ValueError):
        selection.combine(None, None)


def score_of(spark, rows):
    frame = spark.createDataFrame([(n, p, a) for n, (p, a) in enumerate(rows)], "n int, price double, is_available_numeric int")
    return scoring.score(frame).orderBy("n").collect()


def test_scores(spark):
    rows = score_of(spark, [(10.0, 1), (20.0, 1), (30.0, 0)])
    assert [r.price_score for r in rows] == [1.0, 0.5, 0.0]
    assert [r.final_score for r in rows] == pytest.approx([1.0, 0.8, 0.0])
    assert [r.final_score for r in score_of(spark, [(7.0, 1), (7.0, 0)])] == pytest.approx([0.8, 0.2])
    assert [r.price_score for r in score_of(spark, [(1.0, 1), (math.inf, 1)])] == [0.0, 0.0]


def test_scores_without_inputs(spark):
    assert scoring.score(spark.createDataFrame([(1,)], "n int")).first().final_score == 0.0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.floats(0, 1e6), st.integers(0, 1)), min_size=1, max_size=30))
def test_score_properties(spark, rows):
    result = score_of(spark, rows)
    assert all(-1e-9 <= r.final_score <= 1 + 1e-9 for r in result)
    low = min(r.price for r in result)
    if len({r.price for r in result}) > 1:
        assert all(r.price_score == 1.0 for r in result if r.price == low)


def test_ranks_are_positions(spark):
    rows = scored(spark, ("s", "P", 0, 1, "u1", 0.8), ("s", "P", 0, 0, "u2", 0.8), ("s", "P", 0, 2, "u3", 0.5),
                  ("a", "P", 0, 3, "u4", 0.9), ("s", "P", 1, 0, "u0", 0.8))
    assert [(r.rank_overall, r.product_url) for r in ranking.top_k(rows, 3).collect()] == [(1, "u4"), (2, "u0"), (3, "u1")]
    flagship = ranking.flagship(rows, 3).orderBy("source_store_name", "store_rank").collect()
    assert [(r.source_store_name, r.store_rank, r.product_url) for r in flagship] == [
        ("a", 1, "u4"), ("s", 1, "u2"), ("s", 2, "u1"), ("s", 3, "u0")]


def test_top_k_is_a_prefix_of_the_full_ranking(spark):
    rows = spark.range(500).select(
        F.lit("s").alias("source_store_name"), F.lit("P").alias("source_platform"), F.lit(0).alias("source_priority"),
        F.col("id").alias("ordinal"), F.concat(F.lit("u"), "id").alias("product_url"), F.lit("t").alias("title"),
        (F.col("id") % 7 / 7).alias("final_score"), F.lit(1.0).alias("price"), F.lit(1).alias("is_available_numeric"))
    full = [r.product_url for r in ranking.top_k(rows, 500).collect()]
    assert [r.product_url for r in ranking.top_k(rows, 20).collect()] == full[:20]
    assert sorted(r.rank_overall for r in ranking.top_k(rows, 500).collect()) == list(range(1, 501))


def test_numbering_in_ranges(spark):
    """Positions come out the same however many ranges there are, also where one value holds most rows."""
    rows = spark.range(2000).select((F.when(F.col("id") < 1500, 7).otherwise(F.col("id") % 13)).alias("v"), F.col("id").alias("u"))
    order = [F.desc("v"), F.asc("u")]
    wanted = [r.u for r in rows.orderBy(*order).collect()]
    for parts in (1, 7, 64):
        ranked = ranking.numbered(rows, order, "n", parts)
        assert [r.u for r in ranked.orderBy("n").collect()] == wanted
        assert ranked.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first() == (1, 2000, 2000)
    assert ranking.numbered(rows.limit(0), order, "n").count() == 0


def test_every_product_gets_a_position(spark, monkeypatch):
    """The overall ranking goes on beyond ten million products."""
    most = 10_000_003
    rows = spark.range(most).select(
        F.col("id").cast("double").alias("final_score"), F.lit("u").alias("product_url"), F.lit("P").alias("source_platform"),
        *[F.lit(None).cast("string").alias(c) for c in ("title", "source_store_name", "price", "is_available_numeric")])
    monkeypatch.setattr(registry, "scored_rows", lambda *_: rows)
    ranked = registry.rank_all(spark, "")
    assert ranked.agg(F.count("*"), F.min("rank_overall"), F.max("rank_overall")).first() == (most, 1, most)


def test_store_rankings(spark):
    rows = scored(spark, ("s", "B", 1, 0, "u1", 0.2), ("s", "A", 0, 5, "u2", 0.4), ("s", "B", 0, 9, "u3", 0.9),
                  ("t", None, 0, 0, "u4", 0.1))
    got = {r.source_store_name: (round(r.avg_product_score, 6), r.max_product_score, r.source_platform)
           for r in ranking.store_rankings(rows).collect()}
    assert got == {"s": (0.5, 0.9, "A"), "t": (0.1, 0.1, "Unknown")}
    assert [r.source_store_name for r in ranking.store_averages(rows).collect()] == ["s", "t"]
    platforms = ranking.store_platforms(rows).where("source_store_name = 't'")
    joined = ranking.attach_platforms(ranking.store_averages(rows), ranking.store_maxima(rows), platforms)
    assert {r.source_store_name: r.source_platform for r in joined.collect()} == {"s": "Unknown", "t": "Unknown"}


def test_plans(spark):
    rows = scored(spark, ("s", "P", 0, 1, "u1", 0.8))
    assert "TakeOrderedAndProject" in plan_of(ranking.top_k(rows))
    assert "WindowGroupLimit" in plan_of(ranking.flagship(rows))
    combined = selection.combine(structured(spark, ("u", "t", 1.0, "", "s")), scraped(spark, ("u", "t", "1")))
    plan = plan_of(keyed.keep_first(combined))
    assert plan.count("WindowGroupLimit") == 2 and "Python" not in plan
    full = plan_of(selection.scored_catalogue(structured(spark, ("u", "t", 1.0, "", "s")), None))
    assert "CartesianProduct" not in full and "NestedLoop" not in full and "Python" not in full
    assert "SortAggregate" not in plan_of(ranking._store_parts(rows))


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    """A third of all rows share one URL; one row per input task reaches the shuffle."""
    hot = spark.range(0, 90000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), "id")).alias("product_url"),
        F.lit(0).alias("source_priority"), (90000 - F.col("id")).alias("ordinal"))
    kept = keyed.keep_first(hot)
    assert kept.count() == 60001
    assert kept.where("product_url = 'hot'").first().ordinal == 3
    assert keyed.keep_last(hot).where("product_url = 'hot'").first().ordinal == 90000
    written = [line for line in plan_of(kept).splitlines() if "Partial" in line]
    assert written


def test_upsert(spark):
    old = spark.createDataFrame([("u1", "v1", 9), ("u2", "w", 1)], "product_url string, title string, ordinal long")
    new = spark.createDataFrame([("u1", "v2", 1), ("u1", "v3", 2), ("u3", "x", 1)], old.schema)
    state = keyed.upsert(old, new)
    wanted = {("u1", "v3"), ("u2", "w"), ("u3", "x")}
    assert {(r.product_url, r.title) for r in state.collect()} == wanted
    assert {(r.product_url, r.title) for r in keyed.upsert(state, new).collect()} == wanted


def test_folded_key_keeps_the_first_text(spark):
    long = "x" * 255
    rows = spark.createDataFrame([
        ("http://a/Café", 1, "old"), ("http://a/cafe", 2, "new"), (long + "1", 3, "old"), (long + "2", 4, "new"),
        ("b ", 5, "old"), ("B", 6, None)], "product_url string, ordinal long, title string")
    def merged(key):
        return {(r.product_url, r.ordinal, r.title) for r in keyed.merge_written(rows, key=key).collect()}

    assert merged(keyed.folded_key("product_url", 255)) == {("http://a/Café", 2, "new"), (long + "1", 4, "new"), ("b ", 6, None)}
    assert {r[0] for r in merged(keyed.folded_key("product_url"))} == {"http://a/Café", long + "1", long + "2", "b "}
    assert len(merged(None)) == 6


def test_refresh(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "n long"
    rows = spark.range(3).withColumnRenamed("id", "n")
    assert sinks.read_refreshed(spark, path, rows.schema).count() == 0
    assert sinks.refresh(rows, path)
    assert not sinks.refresh(rows.where("n > 9"), path)
    assert sinks.read_refreshed(spark, path, rows.schema).count() == 3
    assert sinks.refresh(sinks.read_refreshed(spark, path, rows.schema).where("n > 0"), path)
    assert sinks.read_refreshed(spark, path, rows.schema).count() == 2


def test_lost_job_leaves_the_last_version(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(3)
    sinks.refresh(rows, path)
    spark.range(9).write.parquet(f"{path}/version=2-deadbeef")
    assert sinks.read_refreshed(spark, path, rows.schema).count() == 3


def test_keyed_table(spark, tmp_path):
    path = str(tmp_path / "k")
    first = spark.createDataFrame([("u1", "a", 5), ("u2", "b", 6)], "product_url string, title string, ordinal long")
    second = spark.createDataFrame([("u1", "c", 1)], first.schema)
    assert sinks.read_keyed(spark, path, first.schema).count() == 0
    sinks.append_batch(first, path, 0)
    for _ in range(2):
        sinks.append_batch(second, path, 1)
    read = {(r.product_url, r.title) for r in sinks.read_keyed(spark, path, first.schema).collect()}
    assert read == {("u1", "c"), ("u2", "b")}
    assert sinks.read_batches(spark, path, first.schema).count() == 3
    for _ in range(2):
        sinks.compact(spark, path, first.schema, count=3)
        assert {(r.product_url, r.title) for r in sinks.read_keyed(spark, path, first.schema).collect()} == read
    sinks.append_batch(spark.createDataFrame([("u2", "d", 0), ("u3", "e", 0)], first.schema), path, 2)
    assert {(r.product_url, r.title) for r in sinks.read_keyed(spark, path, first.schema).collect()} == {
        ("u1", "c"), ("u2", "d"), ("u3", "e")}


def test_contract(spark):
    frame = spark.createDataFrame(
        [("u1", "t", 1.0), ("u1", None, 2.0), (None, "long title", 3.0), (None, "t", 123456789.0), ("u1", "t", None)],
        "product_url string, title string, price double")
    rules = schemas.Contract(not_null=("title",), max_length=(("title", 5),), unique=("product_url",),
                             decimals=(("price", 10, 2),))
    found = {(r.column_name, r.rule): r.violations for r in contract.contract_violations(frame, rules).collect()}
    assert found == {("title", "not null"): 1, ("title", "length <= 5"): 1, ("price", "decimal(10,2)"): 1,
                     ("product_url", "unique"): 2}
    good, bad = contract.split_by_contract(frame, rules)
    assert good.count() == 3
    assert sorted(r.reject_reason for r in bad.collect()) == [
        "price: decimal(10,2)", "title: not null"]
    _, strict = contract.split_by_contract(frame, rules, lengths=True)
    assert sorted(r.reject_reason for r in strict.collect()) == [
        "price: decimal(10,2)", "title: length <= 5", "title: not null"]


def test_save_shape(spark):
    frame = spark.createDataFrame([("u", None, math.nan, 1)], "product_url string, title string, price double, is_available_numeric int")
    row = contract.save_shape(frame, schemas.SCORED_PRODUCTS.names).first()
    assert (row.product_url, row.title, row.price, row.sku, row.final_score) == ("u", "N/A", None, "N/A", None)
    shaped = contract.conform(contract.save_shape(frame, schemas.SCORED_PRODUCTS.names), schemas.SCORED_PRODUCTS)
    assert shaped.schema.simpleString() == schemas.SCORED_PRODUCTS.simpleString()


def test_evolution_is_additive(spark):
    frame = spark.createDataFrame([("u",)], "product_url string")
    fields = [f for f in schemas.SCRAPED_PRODUCTS.fields if f.name in ("product_url", "category")]
    once = align.add_missing_columns(frame, fields)
    assert once.columns == ["product_url", "category"]
    assert align.add_missing_columns(once, fields).columns == once.columns


def test_counters(spark):
    frame = spark.createDataFrame([("s", None), ("s", "bad"), ("t", None)], "store string, reject_reason string")
    got = {r.store: (r.accepted, r.rejected) for r in counters.outcome_counts(frame, "store").collect()}
    assert got == {"s": (1, 1), "t": (1, 0)}


def test_run_selection(spark, tmp_path):
    out = str(tmp_path / "out")
    one = structured(spark, ("u1", "t", 10.0, "Available", "s"), ("u2", "t", 20.0, "Out of Stock", "s"),
                     ("U1", "t", 30.0, "Available", "s"))
    selection.run_selection(one, scraped(spark, ("u3", "x", "$15")), out, run_id=1)
    best = sinks.read_refreshed(spark, f"{out}/top_k_products_overall", schemas.TOP_K_PRODUCTS)
    assert [r.product_url for r in best.orderBy("rank_overall").collect()] == ["u1", "u3", "U1", "u2"]
    saved = {r.product_url: float(r.price) for r in selection.read_scored(spark, out).collect()}
    assert saved == {"u1": 10.0, "U1": 30.0, "u2": 20.0, "u3": 15.0}
    # On request u1 and U1 are one key: the first text, the last values.
    folded = {r.product_url: float(r.price) for r in selection.read_scored(spark, out, folded=True).collect()}
    assert folded == {"u1": 30.0, "u2": 20.0, "u3": 15.0}
    selection.run_selection(structured(spark, ("u9", "t", 1.0, "Available", "s")), None, out, run_id=2)
    assert {r.product_url for r in selection.read_scored(spark, out).collect()} == {"u1", "U1", "u2", "u3", "u9"}
    best = sinks.read_refreshed(spark, f"{out}/top_k_products_overall", schemas.TOP_K_PRODUCTS)
    assert [r.product_url for r in best.collect()] == ["u9"]
    selection.run_selection(structured(spark), None, out, run_id=3)
    for name, schema in [("store_rankings", schemas.STORE_RANKINGS), ("flagship_products_by_store", schemas.FLAGSHIP_PRODUCTS)]:
        assert sinks.read_refreshed(spark, f"{out}/{name}", schema).count() == 1


def test_a_run_needs_an_id(spark, tmp_path):
    with pytest.raises(TypeError):
        selection.run_selection(structured(spark), None, str(tmp_path / "out"))


def test_rejects_and_counts_are_written(spark, tmp_path):
    out = str(tmp_path / "out")
    one = structured(spark, ("u1", "t", 10.0, "Available", "s"), ("u2", "t" * 600, 1e9, "Available", "s"))
    selection.run_selection(one, None, out, run_id=1)
    assert {r.product_url for r in selection.read_scored(spark, out).collect()} == {"u1"}
    fields = T.StructType.fromDDL("product_url string, reject_reason string")
    rejects = sinks.read_batches(spark, f"{out}/scored_rejects", fields).collect()
    assert [(r.product_url, r.reject_reason) for r in rejects] == [("u2", "price: decimal(10,2)")]
    counts = sinks.read_batches(spark, f"{out}/counts", T.StructType.fromDDL("rows long")).collect()
    assert [r.rows for r in counts] == [2]


def test_a_lost_repeat_keeps_the_batch(spark, tmp_path):
    path = str(tmp_path / "k")
    rows = spark.range(3).withColumnRenamed("id", "ordinal")
    sinks.append_batch(rows, path, 4)
    spark.range(9).write.parquet(f"{path}/batch_seq=4/attempt=2-deadbeef")
    assert sinks.read_batches(spark, path, rows.schema).count() == 3


def test_many_per_store_are_cut_in_parts(spark):
    rows = [(f"s{n % 2}", f"u{n}", float(n % 50), 0, n) for n in range(3000)]
    frame = spark.createDataFrame(rows, "source_store_name string, product_url string, final_score double, source_priority int, "
                                        "ordinal long").withColumns({c: F.lit(None).cast("string") for c in (
                                            "title", "source_platform")}).withColumn("price", F.lit(1.0))
    got = {(r.source_store_name, r.store_rank): r.product_url for r in ranking.flagship(frame, 1200).collect()}
    wanted = {}
    for store in ("s0", "s1"):
        best = sorted((r for r in rows if r[0] == store), key=lambda r: (-r[2], r[4]))[:1200]
        wanted.update({(store, n + 1): r[1] for n, r in enumerate(best)})
    assert got == wanted


@pytest.mark.parametrize("name, rows, schema, rules, broken", [
    ("top", [(1, "u"), (2, None), (3, "u")], "rank_overall int, product_url string", schemas.TOP_K_CONTRACT,
     {("product_url", "not null"): 1, ("product_url", "unique"): 1}),
    ("flagship", [("s", 1, "u"), ("s", 2, "u"), (None, 1, "u")], "source_store_name string, store_rank int, product_url string",
     schemas.FLAGSHIP_CONTRACT, {("source_store_name", "not null"): 1, ("source_store_name, product_url", "unique"): 1}),
    ("stores", [("s",), ("s",), (None,)], "source_store_name string", schemas.STORE_RANKINGS_CONTRACT,
     {("source_store_name", "not null"): 1, ("source_store_name", "unique"): 1}),
])
def test_report_contracts(spark, name, rows, schema, rules, broken):
    found = contract.contract_violations(spark.createDataFrame(rows, schema), rules).collect()
    assert {(r.column_name, r.rule): r.violations for r in found if r.violations} == broken


@pytest.fixture
def small_tasks(spark, monkeypatch):
    """Tables count as large from 100 rows on; the session's settings come back afterwards."""
    names = ["spark.sql.shuffle.partitions", *session.BYTES_A_TASK]
    before = {name: spark.conf.get(name) for name in names}
    monkeypatch.setattr(session, "ROWS_A_TASK", 100)
    yield before
    for name, value in before.items():
        spark.conf.set(name, value)


def test_tasks_stay_small_as_tables_grow(spark, small_tasks):
    largest = {}
    for rows in (1_000, 10_000):
        dealt = testtables.spread(spark.range(rows), "id")
        assert dealt.count() == dealt.distinct().count() == rows
        largest[rows] = dealt.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == max(8, rows // 100)
    assert largest[10_000] < 2 * largest[1_000] < 400
    assert all(int(spark.conf.get(name)) == most for name, most in session.BYTES_A_TASK.items())


def test_small_tables_and_smaller_settings_change_nothing(spark, small_tasks):
    assert session.size_shuffles(spark, 0) == 0 and session.size_shuffles(spark, 100) == 1
    assert {name: spark.conf.get(name) for name in small_tasks} == small_tasks
    for name in session.BYTES_A_TASK:
        spark.conf.set(name, "1m")
    spark.conf.set("spark.sql.shuffle.partitions", 30)
    assert session.size_shuffles(spark, 1_001) == 11
    assert spark.conf.get("spark.sql.shuffle.partitions") == "30"
    assert [spark.conf.get(name) for name in session.BYTES_A_TASK] == ["1m", "1m"]


def test_a_single_batch_without_repeats_is_not_shuffled(spark, tmp_path):
    out = str(tmp_path / "out")
    one = structured(spark, ("u1", "a", 10.0, "Available", "s"), ("u1", "b", 11.0, "", "s"), (None, "c", 2.0, "", "s"))
    selection.run_selection(one, scraped(spark, ("u2", "x", "$5")), out, run_id=1)
    alone = selection.read_scored(spark, out)
    assert "Exchange" not in plan_of(alone)
    assert {r.product_url: r.title for r in alone.collect()} == {"u1": "a", "N/A": "c", "u2": "x"}
    assert "Exchange" in plan_of(selection.read_scored(spark, out, folded=True))
    selection.run_selection(structured(spark, ("u2", "y", 1.0, "", "s")), None, out, run_id=2)
    assert {r.product_url: r.title for r in selection.read_scored(spark, out).collect()} == {"u1": "a", "N/A": "c", "u2": "y"}


def test_a_missing_url_and_the_text_for_it_are_one_product(spark, tmp_path):
    """Stored under the same text, they are a repeated key of one batch; the later one stays."""
    out = str(tmp_path / "out")
    selection.run_selection(structured(spark, (None, "a", 1.0, "", "s"), ("N/A", "b", 2.0, "", "s")), None, out, run_id=1)
    assert [(r.product_url, r.title) for r in selection.read_scored(spark, out).collect()] == [("N/A", "b")]
    table = str(tmp_path / "table")
    for repeat in (1, 2):
        sinks.append_batch(spark.createDataFrame([("u", 1, "a"), ("u", 2, "b")], "product_url string, ordinal long, t string"), table, repeat)
    rows = sinks.read_keyed(spark, table, T.StructType.fromDDL("product_url string, ordinal long, t string"))
    assert [r.t for r in rows.collect()] == ["b"]
