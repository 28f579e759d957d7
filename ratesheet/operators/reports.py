"""Dashboard reports over the enriched table.

Each report reads only its own columns, and its null and range filters sit directly on
the scan so that they reach Parquet. Rankings break ties by name.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ratesheet.functions import values


def _has_text(c: str):
    return F.col(c).isNotNull() & (F.col(c) != "")


def top_drugs(enriched: DataFrame, n: int = 20, form: str | None = None) -> DataFrame:
    """Row count per product name, the ``n`` largest."""
    rows = enriched.where(_has_text("drug_name"))
    if form:
        rows = rows.where(F.col("drug_form") == form)
    return (
        rows.groupBy("drug_name")
        .agg(F.count(F.lit(1)).alias("record_count"))
        .orderBy(F.desc("record_count"), "drug_name")
        .limit(n)
    )


def form_counts(enriched: DataFrame) -> DataFrame:
    return (
        enriched.where(_has_text("drug_form"))
        .groupBy("drug_form")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def form_distribution(enriched: DataFrame, n: int = 10) -> DataFrame:
    """Counts of the ``n`` most frequent forms, all others summed as ``Other``.

    The ranking is a top-``n`` heap per task rather than a global row number, which would
    pull every distinct form into one task. The ``n`` names found are joined back to the
    same counts; ``n`` bounds the broadcast.
    """
    counts = form_counts(enriched)
    top = counts.orderBy(F.desc("cnt"), "drug_form").limit(n)
    top = top.select("drug_form", F.lit(True).alias("is_top"))
    bucket = F.when(F.col("is_top"), F.col("drug_form")).otherwise("Other")
    return (
        counts.join(F.broadcast(top), "drug_form", "left")
        .select(bucket.alias("drug_form"), "cnt")
        .groupBy("drug_form")
        .agg(F.sum("cnt").alias("cnt"))
        .orderBy(F.desc("cnt"), "drug_form")
    )


def form_value_counts(enriched: DataFrame, n: int = 5) -> DataFrame:
    """Most frequent forms, nulls left out."""
    return (
        enriched.where(F.col("drug_form").isNotNull())
        .groupBy("drug_form")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy(F.desc("n_rows"), "drug_form")
        .limit(n)
    )


def price_trend(
    enriched: DataFrame, as_of: dt.date, days: int = 90, ndc: str | None = None
) -> DataFrame:
    """Average price per day over the trailing window.

    ``as_of`` is a plain date so the bound is a literal at planning time: it reaches the
    Parquet filter, and prunes quarter partitions when the table has them.
    """
    first = as_of - dt.timedelta(days=days)
    rows = enriched.where(F.col("effective_date") >= F.lit(first))
    if "effective_quarter" in enriched.columns:
        rows = rows.where(F.col("effective_quarter") >= values.quarter_text(first))
    if ndc:
        rows = rows.where(F.col("ndc") == ndc)
    return (
        rows.groupBy(F.to_date("effective_date").alias("d"))
        .agg(F.avg(values.price_number(F.col("nadac_per_unit"))).alias("avg_nadac"))
        .orderBy("d")
    )


def strength_vs_price(enriched: DataFrame, n: int = 2000) -> DataFrame:
    """A stable sample of ``n`` (strength, price) points."""
    rows = enriched.dropna(subset=["drug_strength", "nadac_per_unit"])
    points = rows.select(
        F.col("drug_strength").try_cast("double").alias("strength_val"),
        values.price_number(F.col("nadac_per_unit")).alias("nadac_value"),
        "drug_form",
        "drug_name",
    )
    return points.orderBy("drug_name", "strength_val", "nadac_value", "drug_form").limit(n)


def avg_price_by_drug(enriched: DataFrame, n: int = 20) -> DataFrame:
    """Average price per product, the ``n`` dearest (ranked on the rounded average)."""
    price = values.price_number(F.col("nadac_per_unit"))
    return (
        enriched.where(F.col("drug_name").isNotNull())
        .groupBy("drug_name")
        .agg(F.round(F.avg(price), 6).alias("avg_price"))
        .orderBy(F.desc("avg_price"), "drug_name")
        .limit(n)
    )


def latest_rows(df: DataFrame, by: str, n: int = 10) -> DataFrame:
    """Newest ``n`` rows; every other column breaks ties."""
    rest = [c for c in df.columns if c != by]
    return df.orderBy(F.desc(by), *rest).limit(n)


def drug_lookup(enriched: DataFrame, name_part: str, form: str) -> DataFrame:
    return enriched.where(F.contains("drug_name", F.lit(name_part)) & (F.col("drug_form") == form))


def avg_price_in_quarter(enriched: DataFrame, quarter: str, n: int = 100) -> DataFrame:
    """Dearest products of one quarter; on a quarter-partitioned table only that
    partition is read."""
    return avg_price_by_drug(enriched.where(F.col("effective_quarter") == quarter), n)


def data_summary(enriched: DataFrame, approximate: bool = False) -> DataFrame:
    """Rows, distinct names and codes, price range."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    price = values.price_number(F.col("nadac_per_unit"))
    return enriched.agg(
        F.count(F.lit(1)).alias("n_rows"),
        distinct("drug_name").alias("n_drugs"),
        distinct("ndc").alias("n_ndcs"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
    )
