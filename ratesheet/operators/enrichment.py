"""Staging rows -> enriched rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ratesheet import fixed_values as fv
from ratesheet.functions import text, values


def _parsed(df: DataFrame, cut, fields) -> DataFrame:
    """Parse in two projections: the cut is computed once per row and then read by all
    fields. In one projection each field would compute it again."""
    c = F.col("ndc_description")
    return df.withColumn("_cut", cut(c)).withColumns(fields(F.col("_cut"), c)).drop("_cut")


def parse_descriptions(df: DataFrame) -> DataFrame:
    return _parsed(df, text.cut_description, text.description_fields)


def parse_descriptions_legacy(df: DataFrame) -> DataFrame:
    return _parsed(df, text.legacy_cut, text.legacy_fields)


def _derive(df: DataFrame, parse, run_ts: Column | None) -> DataFrame:
    return parse(df.withColumn("ndc_description", F.trim("ndc_description"))).withColumns(
        {
            "explanation_code_description": text.explain_codes(F.col("explanation_code")),
            "enriched_timestamp": F.current_timestamp() if run_ts is None else run_ts,
        }
    )


def enrich(staged: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Six derived columns; ``run_ts`` replaces the clock for repeatable runs."""
    return _derive(staged, parse_descriptions, run_ts)


def enrich_legacy(staged: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Same columns by the older positional rules, with an integer strength."""
    return _derive(staged, parse_descriptions_legacy, run_ts)


def code_table(spark: SparkSession) -> DataFrame:
    """The ten explanation codes as a table."""
    return spark.range(1).select(
        F.explode(text.lookup(fv.EXPLANATION_CODES)).alias("code", "code_text")
    )


def explain_codes_join(df: DataFrame) -> DataFrame:
    """Texts per distinct code list, by joining the code table.

    Rows are counted per code list first (map-side partial counts absorb a hot list),
    so the exploded side holds distinct lists only and the regrouping collects no more
    than the codes of one list. The broadcast side is the ten-row code table.
    """
    lists = df.groupBy("explanation_code").agg(F.count(F.lit(1)).alias("n_rows"))
    exploded = lists.select(
        "explanation_code",
        "n_rows",
        F.posexplode_outer(text.code_list(F.col("explanation_code"))).alias("place", "code"),
    )
    joined = exploded.join(F.broadcast(code_table(df.sparkSession)), "code", "left")
    found = F.collect_list(F.when(F.col("code_text").isNotNull(), F.struct("place", "code_text")))
    ordered = F.array_join(
        F.transform(F.sort_array(F.col("found")), lambda x: x["code_text"]),
        fv.EXPLANATION_SEPARATOR,
    )
    return (
        joined.groupBy("explanation_code", "n_rows")
        .agg(found.alias("found"))
        .select(
            "explanation_code",
            F.when(F.size("found") > 0, ordered).alias("explanation_code_description"),
            "n_rows",
        )
    )


def typed(enriched: DataFrame) -> DataFrame:
    """Seventeen columns with numeric prices, for rows that have a text and a name.

    Plain casts: price texts must already be numeric.
    """
    numeric = {
        c: F.col(c).cast("double")
        for c in ("nadac_per_unit", "corresponding_generic_drug_nadac_per_unit")
    }
    columns = [
        "ndc", "ndc_description", "drug_name", "drug_strength", "drug_dosage", "drug_form",
        "nadac_per_unit", "pricing_unit", "pharmacy_type_indicator", "otc", "explanation_code",
        "explanation_code_description", "classification_for_rate_setting",
        "corresponding_generic_drug_nadac_per_unit", "corresponding_generic_drug_effective_date",
        "as_of_date", "effective_date",
    ]
    return (
        enriched.dropna(subset=["ndc_description", "drug_name"])
        .withColumns(numeric)
        .select(*columns)
    )


def clean_price_texts(df: DataFrame) -> DataFrame:
    """Price texts reduced to digits and dots, still text."""
    return df.withColumns(
        {
            c: F.regexp_replace(c, r"[^0-9.]", "")
            for c in ("nadac_per_unit", "corresponding_generic_drug_nadac_per_unit")
        }
    )


def decode_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "classification_text": text.classification_name(
                F.col("classification_for_rate_setting")
            ),
            "pharmacy_text": text.pharmacy_name(F.col("pharmacy_type_indicator")),
            "otc_text": text.otc_name(F.col("otc")),
        }
    )


def with_quarter(df: DataFrame) -> DataFrame:
    return df.withColumn("effective_quarter", values.quarter_label(F.col("effective_date")))
