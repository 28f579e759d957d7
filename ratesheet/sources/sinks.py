"""Writers and table layouts.

A table is a set of loads, one folder each: adding a load never touches another, and repeating
one replaces what its first try left. A load is made aside and published with one move, so readers
see all of it or none. Partition columns inside a load are dates or quarters, never product codes.

Rows are placed by ranges of the clustering columns, whose bounds come from sketches that earlier
loads left (``ranges``). Without any, a pass of its own makes the sort numbers of the rows and no
other column. Either way rows are made and parsed whole once, and a clustering key (or a group of equal rows)
holding a large share of the data is cut into several ranges by the task its rows come from, which
is the same again when a lost task is repeated.

``n`` is the number of ranges; without it the session's shuffle setting applies.

An enriched load also says which staging loads it was made of: together these are the ledger
(``ledger``), published with the rows.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ratesheet.functions import values
from ratesheet.operators.enrichment import with_quarter
from ratesheet.sources import ranges, storage
from ratesheet.sources.named_files import NamedFiles
from ratesheet.sources.tables import CORRUPT

LOAD = "load_id"
#: Where loads are made, and where a load keeps the names of those it was made of.
INCOMING, SOURCES = "_incoming", "_sources"
LEDGER = "source string"
#: Pages in a row group of a table of pages.
PAGE_GROUP_ROWS = 8
#: Rows of a range below which a write takes fewer ranges, unless told how many.
LEAST_ROWS = 20_000
ENRICHED_CLUSTERING = ["drug_name", "ndc", "drug_strength", "drug_form"]
STAGING_CLUSTERING = ["ndc_description", "pricing_unit", "otc", "classification_for_rate_setting"]


def _ranges(df: DataFrame, n: int | None) -> int:
    return n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _clustered(
    df: DataFrame, keys: list[str], n: int | None, number: Column, limits: list[int] | None
) -> DataFrame:
    if limits is None:
        limits = ranges.measured(df, number, _ranges(df, n), 1 if n else LEAST_ROWS)
    if limits is not None:
        return ranges.deal(df, number, limits).sortWithinPartitions(*keys)
    spread, columns = df.withColumn("_task", F.spark_partition_id()), [*keys, "_task"]
    ranged = spread.repartitionByRange(n, *columns) if n else spread.repartitionByRange(*columns)
    return ranged.sortWithinPartitions(*keys).drop("_task")


def load_dir(path: str, load_id: str) -> str:
    """Folder of one load in a table. A repeated load replaces its own folder and no other."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", load_id):
        raise ValueError(f"not a load id: {load_id!r}")
    return f"{path}/{LOAD}={load_id}"


def load_dirs(spark: SparkSession, path: str) -> list[str]:
    """Folders of the loads of a table, by name."""
    return sorted(f"{path}/{name}" for name, _ in storage.folders(spark, path) if name.startswith(f"{LOAD}="))


def _by_price_key(text: str) -> Column:
    day = F.col("effective_date")
    return ranges.sort_number(F.year(day) * 4 + F.quarter(day), F.ltrim(text))


def _by_name(text: str) -> Column:
    return ranges.sort_number(F.lit(0), F.ltrim(text))


def write_enriched(
    df: DataFrame,
    path: str,
    load_id: str,
    by: str = "enriched_date",
    n: int | None = None,
    counts: Observation | None = None,
    sources: list[str] | None = None,
) -> None:
    """Adds a load of enriched rows, by run day or by ``effective_quarter`` for the price reports.

    ``counts`` observes the rows on their way to the files. ``sources`` names the staging loads
    that the rows were made of, for the ledger; their sketches of descriptions, which begin with
    the name, give the bounds of the ranges.
    """
    spark = df.sparkSession
    if by == "enriched_date":
        laid_out, name, number = df.withColumn(by, F.to_date("enriched_timestamp")), "name", _by_name
    else:
        laid_out, name, number = with_quarter(df), "price_key", _by_price_key
    limits = ranges.bounds(spark, sources or [], name, _ranges(df, n))
    rows = _clustered(laid_out, [by, *ENRICHED_CLUSTERING], n, number("ndc_description"), limits)
    if counts is not None:
        rows = rows.observe(counts, F.count(F.lit(1)).alias("rows_written"))
    made = f"{path}/{INCOMING}/{load_id}"
    rows.write.partitionBy(by).mode("overwrite").parquet(made)
    if sources is not None:
        named = [(storage.qualified(spark, s),) for s in sources]
        spark.createDataFrame(named, LEDGER).coalesce(1).write.mode("overwrite").parquet(f"{made}/{SOURCES}")
    storage.publish(spark, made, load_dir(path, load_id))


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """(source, load_id): the staging loads that an enriched table holds, and in which load."""
    found = [f"{load}/{SOURCES}" for load in load_dirs(spark, path)]
    found = [place for place in found if storage.exists(spark, place)]
    if not found:
        return spark.createDataFrame([], f"{LEDGER}, load_id string")
    load_id = F.regexp_extract(F.col("_metadata.file_path"), f"/{LOAD}=([^/]+)/{SOURCES}/", 1)
    return spark.read.schema(LEDGER).parquet(*found).select("source", load_id.alias("load_id"))


def write_staging(df: DataFrame, path: str, load_id: str, n: int | None = None) -> None:
    """Adds a load of staging rows, placed by code range and clustered.

    The code ranges order the files rather than name folders: 100,000 possible folders
    would leave tiny files. The latest load with a sketch gives the bounds; this one leaves
    sketches of its own codes, names and price keys, observed as it is written.
    """
    spark = df.sparkSession
    keys = ["ndc_bucket", *STAGING_CLUSTERING]
    placed = df.withColumn("ndc_bucket", values.ndc_range_bucket(F.col("ndc")))
    by_code = ranges.sort_number(F.col("ndc_bucket"), F.col("ndc_description"), text_bytes=5)
    loads = [found for found in storage.folders(spark, path) if found[0].startswith(f"{LOAD}=")]
    latest = [f"{path}/{name}" for name, _ in sorted(loads, key=lambda found: found[1])[-1:]]
    limits = ranges.bounds(spark, latest, "code", _ranges(df, n))
    sketches = Observation("sketches")
    numbers = {
        "code": by_code,
        "name": _by_name("ndc_description"),
        "price_key": _by_price_key("ndc_description"),
    }
    rows = ranges.observed(_clustered(placed, keys, n, by_code, limits), numbers, sketches)
    made = f"{path}/{INCOMING}/{load_id}"
    rows.drop("ndc_bucket").write.mode("overwrite").parquet(made)
    ranges.keep_sketches(spark, made, sketches.get)
    storage.publish(spark, made, load_dir(path, load_id))


def write_load(df: DataFrame, path: str, load_id: str) -> None:
    """Adds a load of rows as they are."""
    df.write.mode("overwrite").parquet(load_dir(path, load_id))


def write_daily(df: DataFrame, path: str, day_col: str = "date") -> None:
    """Rows of a daily job, replacing that day only."""
    writer = df.write.partitionBy(day_col).option("partitionOverwriteMode", "dynamic")
    writer.mode("overwrite").parquet(path)


def write_pages(parts: DataFrame, path: str) -> None:
    """Page parts as a table. A page is megabytes of text, and readers take a row group at a time."""
    writer = parts.write.option("parquet.block.row.count.limit", PAGE_GROUP_ROWS)
    writer.option("compression", "zstd").parquet(path)


def land_pages(
    pages: DataFrame, path: str, column: str = "body", landing: str | None = None, packed: bool = False
) -> int:
    """Page files by their own names (``file_name``) in a folder of this landing; the number landed.

    ``packed`` files have ``.gz`` behind their names; readers unpack them as they go.
    Tasks write the files; all of them appear with one move. A landing of the same name is replaced.
    Masses of small pages go into few files with ``land_page_lines``.
    """
    spark, landed = pages.sparkSession, Observation("landing")
    spark.dataSource.register(NamedFiles)
    named = pages.select("file_name", column).observe(landed, F.count(F.lit(1)).alias("n"))
    (
        named.write.format("named_files")
        .mode("append")
        .option("path", storage.qualified(spark, path))
        .option("landing", landing or uuid.uuid4().hex)
        .option("packed", str(packed).lower())
        .save()
    )
    return landed.get["n"]


def land_page_lines(pages: DataFrame, path: str, column: str = "body", packed: bool = False) -> None:
    """Page bodies as lines, many to a file."""
    writer = pages.select(column).write
    if packed:
        writer = writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    writer.text(path)


def land_lines(lines: DataFrame, path: str) -> None:
    lines.write.text(path)


def write_or_quarantine(df: DataFrame, path: str, quarantine_path: str, load_id: str) -> None:
    """Readable rows as a load of ``path``, the text of broken lines as one of ``quarantine_path``.

    The rows are kept while both are written: the JSON source does not parse a line for its
    broken text alone.
    """
    kept = df.persist()
    broken = F.col(CORRUPT).isNotNull()
    write_load(kept.where(~broken).drop(CORRUPT), path, load_id)
    kept.where(broken).select(CORRUPT).write.mode("overwrite").text(load_dir(quarantine_path, load_id))
    kept.unpersist()
