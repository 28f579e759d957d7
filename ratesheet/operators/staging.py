"""Arriving records -> staging rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratesheet import schemas
from ratesheet.functions import values


def empty_staging(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.STAGING)


def conform(df: DataFrame) -> DataFrame:
    """The twelve staging columns in order: missing ones null, others dropped."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schemas.STAGING.fields
        ]
    )


def drop_invalid_ndc(df: DataFrame) -> DataFrame:
    """Rows whose product code has at least one digit, with the code reduced to digits."""
    valid = df.where(values.has_ndc(F.col("ndc")))
    return valid.withColumn("ndc", values.keep_digits(F.col("ndc")))


def stage_transform(df: DataFrame) -> DataFrame:
    """Clean codes, parse dates, conform columns. One projection and one filter."""
    dates = {
        name: values.parse_date(F.col(name)) for name in schemas.DATE_COLUMNS if name in df.columns
    }
    return conform(drop_invalid_ndc(df).withColumns(dates))


def stage_metrics(df: DataFrame) -> DataFrame:
    """Rows read, removed and kept, counted in one pass."""
    valid = F.coalesce(values.has_ndc(F.col("ndc")), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(~valid).alias("rows_removed"),
        F.count_if(valid).alias("rows_written"),
    )


def ndc_bucket_counts(staged: DataFrame) -> DataFrame:
    bucket = values.ndc_range_bucket(F.col("ndc")).alias("ndc_bucket")
    return staged.groupBy(bucket).agg(F.count(F.lit(1)).alias("n_rows"))
