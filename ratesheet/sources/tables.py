"""Readers for the stored tables, with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ratesheet import schemas

CORRUPT = "_corrupt_record"


def read_staging(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.STAGING).parquet(path).select(*schemas.STAGING_COLUMNS)


def read_staging_loads(spark: SparkSession, loads: list[str]) -> DataFrame:
    """The rows of some loads of a staging table, by their folders."""
    return spark.read.schema(schemas.STAGING).parquet(*loads).select(*schemas.STAGING_COLUMNS)


def read_enriched(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Rows that have a text and a name, all columns, optionally the first ``limit``.

    Layout columns (``enriched_date``, ``effective_quarter``) come from the folder names.
    """
    stored = spark.read.schema(schemas.ENRICHED).parquet(path).drop("load_id")
    rows = stored.where(F.col("ndc_description").isNotNull() & F.col("drug_name").isNotNull())
    return rows.limit(limit) if limit else rows


def read_sensor(spark: SparkSession, path: str, whole_file: bool = True) -> DataFrame:
    """Sensor JSON. ``whole_file`` reads indented documents or one array per file; line
    by line files should be read without it, so that large files split over tasks."""
    return spark.read.schema(schemas.SENSOR).option("multiLine", whole_file).json(path)


def read_processed_sensor(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PROCESSED_SENSOR).parquet(path).drop("load_id")


def read_or_quarantine(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines in permissive mode: a broken line keeps its text in ``_corrupt_record``."""
    corrupt = T.StructField(CORRUPT, T.StringType(), True)
    return (
        spark.read.schema(T.StructType([*schema.fields, corrupt]))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )
