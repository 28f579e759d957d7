"""Text documents built from enriched rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ratesheet import fixed_values as fv
from ratesheet.functions import text


def _line(label: str, value: Column) -> Column:
    """``label`` and value; null (and so skipped by ``concat_ws``) when there is none."""
    return F.concat(F.lit(label), value.cast("string"))


def _price(c: Column) -> Column:
    """Two decimals behind a dollar sign; null when the text is not a number."""
    return F.concat(F.lit("$"), text.money(c.try_cast("double")))


def drug_document(df: DataFrame) -> Column:
    """Up to fourteen lines per row; the route line needs a ``drug_route`` column.

    Fixed values: the labels and their order.
    """
    c = F.col
    route = [_line("Route of Administration: ", c("drug_route"))] if "drug_route" in df.columns else []
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Drug Name: "), F.coalesce(c("drug_name"), F.lit("None"))),
        F.concat(F.lit("NDC Code: "), F.coalesce(c("ndc"), F.lit("None"))),
        _line("Strength: ", c("drug_strength")),
        _line("Form: ", c("drug_form")),
        *route,
        _line("Price per Unit: ", _price(c("nadac_per_unit"))),
        _line("Pricing Unit: ", c("pricing_unit")),
        _line("Effective Date: ", c("effective_date")),
        _line("Classification: ", text.classification_name(c("classification_for_rate_setting"))),
        _line("Type: ", text.otc_name(c("otc"))),
        _line("Available at: ", text.pharmacy_name(c("pharmacy_type_indicator"))),
        _line("Explanation Code: ", c("explanation_code")),
        _line("Note: ", c("explanation_code_description")),
        _line("Generic Drug Price: ", _price(c("corresponding_generic_drug_nadac_per_unit"))),
    )


def rich_description() -> Column:
    """One sentence per row. The labels and their order."""
    c = F.col
    price = F.concat(
        F.lit("Price: $"),
        c("nadac_per_unit").cast("string"),
        F.lit(" per "),
        F.coalesce(c("pricing_unit"), F.lit("None")),
    )
    parts = F.concat_ws(
        ". ",
        _line("Drug: ", c("ndc_description")),
        _line("Name: ", c("drug_name")),
        _line("Strength: ", c("drug_strength")),
        _line("Dosage: ", c("drug_dosage")),
        _line("Form: ", c("drug_form")),
        price,
    )
    return F.concat(parts, F.lit("."))


def doc_metadata(df: DataFrame) -> DataFrame:
    """Document text with its metadata; missing values take their defaults."""
    return df.select(
        F.coalesce("ndc", F.lit("None")).alias("ndc"),
        F.coalesce("drug_name", F.lit("None")).alias("drug_name"),
        F.coalesce("drug_form", F.lit("")).alias("drug_form"),
        F.coalesce(F.col("nadac_per_unit").cast("double"), F.lit(0.0)).alias("price"),
        F.coalesce(F.col("effective_date").cast("string"), F.lit("")).alias("effective_date"),
        F.lit(fv.DOCUMENT_SOURCE).alias("source"),
        "ndc_description",
        "pricing_unit",
        drug_document(df).alias("text"),
    )
