"""The selection run: harmonise, clean, score, rank, publish."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wareloom import schemas
from wareloom.functions import text
from wareloom.operators import align, contract, counters, keyed, ranking, scoring, sinks
from wareloom.session import stage
from wareloom.sources.catalogues import scan_scraped, scan_structured

# Stored rows keep the order columns: they decide which of two writes is later.
SCORED_LOG = T.StructType([
    *schemas.SCORED_PRODUCTS.fields,
    T.StructField("source_priority", T.IntegerType()),
    T.StructField("ordinal", schemas.ORDINAL),
    T.StructField("analysis_timestamp", T.TimestampType()),
])


def combine(structured: DataFrame | None, scraped: DataFrame | None) -> DataFrame:
    """Aligned rows of the sources that are there, the structured one first."""
    frames = []
    if structured is not None:
        frames.append(align.align(scan_structured(structured)))
    if scraped is not None:
        frames.append(align.align(scan_scraped(scraped)))
    if not frames:
        raise ValueError("no source given")
    return align.concat(frames)


def harmonise(structured: DataFrame | None, scraped: DataFrame | None) -> DataFrame:
    """One row per product URL; the structured source wins."""
    return keyed.keep_first(combine(structured, scraped), "product_url", schemas.ORDER_COLUMNS)


def preprocess(combined: DataFrame) -> DataFrame:
    """Drop rows without a price, add the availability flag and plain description, mark missing text."""
    types = dict(combined.dtypes)
    cleaned = combined
    if "price" in types:
        cleaned = cleaned.withColumn("price", text.clean_price(F.col("price"), types["price"]))
        cleaned = cleaned.where(F.col("price").isNotNull())
    flag = text.availability_flag(F.col("availability")) if "availability" in types else F.lit(0)
    plain = text.strip_html(F.col("description")) if "description" in types else F.lit("")
    return text.fill_missing(cleaned.withColumns({"is_available_numeric": flag, "description_text": plain}))


def scored_catalogue(structured: DataFrame | None, scraped: DataFrame | None, columns: list[str] | None = None,
                     **weights) -> DataFrame:
    """Everything up to the scores.

    Scoring reads the cleaned rows twice, for the price bounds and for the
    scores, so they are written out once instead of merging the sources twice.
    ``columns`` names what is needed besides the scores' own inputs.
    """
    rows = preprocess(harmonise(structured, scraped))
    if columns is not None:
        needed = {*columns, *schemas.SCORE_INPUTS}
        rows = rows.select(*[c for c in rows.columns if c in needed])
    rows = stage(rows)
    return scoring.score(rows, bounds=scoring.known_bounds(rows), **weights)


def judged_products(scored: DataFrame) -> DataFrame:
    """Scored rows in the shape they are stored in, with ``reject_reason``."""
    shaped = contract.save_shape(scored, [c for c in SCORED_LOG.names if c != "analysis_timestamp"])
    return shaped.withColumn("reject_reason", contract.broken_rule(schemas.SCORED_CONTRACT, shaped.columns))


def run_selection(structured: DataFrame | None, scraped: DataFrame | None, out: str, run_id: int,
                  k: int = schemas.TOP_K, n: int = schemas.FLAGSHIP_PER_STORE, **weights) -> None:
    """Publish the four result tables under ``out``, and the run's rejects and counts.

    The cleaned rows, written once, feed the price bounds, the three reports
    and the saved table. Scored products accumulate over runs, each run under
    its own ``run_id``; the reports are replaced.
    """
    scored = scored_catalogue(structured, scraped, **weights)
    if not scored.isEmpty():
        judged = judged_products(scored)
        fitting = contract.conform(judged.where(F.col("reject_reason").isNull()), SCORED_LOG)
        # One row per URL, but a row without one is stored under the text that another may have for its URL.
        unnamed = F.col("product_url").isNull() | (F.col("product_url") == schemas.NOT_AVAILABLE)
        unique = scored.where(unnamed).limit(2).count() < 2
        sinks.append_batch(
            fitting.withColumn("analysis_timestamp", F.current_timestamp()), f"{out}/scored_products", run_id, unique)
        rejects = judged.where(F.col("reject_reason").isNotNull()).select("product_url", "title", "price", "reject_reason")
        sinks.append_batch(rejects, f"{out}/scored_rejects", run_id)
        sinks.append_batch(counters.source_counts(scored), f"{out}/counts", run_id)
    reports = [
        ("top_k_products_overall", ranking.top_k(scored, k), schemas.TOP_K_PRODUCTS),
        ("flagship_products_by_store", ranking.flagship(scored, n), schemas.FLAGSHIP_PRODUCTS),
        ("store_rankings", ranking.store_rankings(scored), schemas.STORE_RANKINGS),
    ]
    for name, rows, schema in reports:
        sinks.refresh(contract.conform(rows, schema).withColumn("analysis_timestamp", F.current_timestamp()), f"{out}/{name}")


def read_scored(spark: SparkSession, out: str, folded: bool = False, times: bool = False) -> DataFrame:
    """Scored products over all runs, one row per URL, or per URL but for case and accents; ``times`` adds when each was written."""
    merged = sinks.read_keyed(spark, f"{out}/scored_products", SCORED_LOG, "product_url", schemas.ORDER_COLUMNS, folded=folded)
    return merged.select(*schemas.SCORED_PRODUCTS.names, *(["analysis_timestamp"] if times else []))
