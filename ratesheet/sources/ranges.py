"""Placing rows in ranges by quantile sketches, without a pass that samples them first.

A sort number stands for the leading sort columns. While a load is written, sketches of its sort
numbers are observed and stored beside it. Merged sketches of earlier loads give the bounds of the
ranges that a later write deals its rows to; without any, the rows' own sort numbers are sketched
first, in a pass that makes no other column. Bounds decide where rows lie, never which are written:
from sketches that do not fit the data any more come uneven ranges, not wrong ones.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ratesheet.sources import storage

#: Bytes of text in a sort number; the leading part has the bits that are left of 63.
TEXT_BYTES = 6
SKETCH_FOLDER = "_sketches"
SKETCHES = "name string, sketch binary"


def sort_number(leading: Column, text: Column, text_bytes: int = TEXT_BYTES) -> Column:
    """Orders rows by ``leading`` (0 and up; null first), then by the first bytes of ``text``."""
    most = F.lit((1 << (63 - 8 * text_bytes)) - 1)
    lead = F.least(F.greatest(F.coalesce(leading.cast("bigint"), F.lit(0)), F.lit(0)), most)
    head = F.hex(F.substring(F.coalesce(text, F.lit("")).cast("binary"), 1, text_bytes))
    number = F.conv(F.rpad(head, 2 * text_bytes, "0"), 16, 10).cast("bigint")
    return lead * F.lit(1 << (8 * text_bytes)) + number


def observed(df: DataFrame, numbers: dict[str, Column], into: Observation) -> DataFrame:
    """``df``, whose sort numbers are sketched on their way to the files.

    They are made as columns first: columns are compiled, what stands inside a measure is not.
    """
    made = {f"_sketch_{name}": number for name, number in numbers.items()}
    measures = [F.kll_sketch_agg_bigint(f"_sketch_{name}").alias(name) for name in numbers]
    return df.withColumns(made).observe(into, *measures).drop(*made)


def keep_sketches(spark: SparkSession, load: str, measured: dict[str, object]) -> None:
    """Stores the observed sketches in the folder of a load."""
    rows = [(name, bytes(sketch)) for name, sketch in measured.items() if sketch is not None]
    spark.createDataFrame(rows, SKETCHES).coalesce(1).write.mode("overwrite").parquet(f"{load}/{SKETCH_FOLDER}")


def bounds(spark: SparkSession, loads: list[str], name: str, n: int) -> list[int] | None:
    """``n - 1`` bounds of even ranges over the loads that have a sketch; None if none has.

    Each load's sketch is a few KB, and they are merged by a task.
    """
    found = [f"{load}/{SKETCH_FOLDER}" for load in loads]
    found = [path for path in found if storage.exists(spark, path)]
    if n < 2 or not found:
        return None
    ranks = F.array(*[F.lit(k / n) for k in range(1, n)])
    merged = (
        spark.read.schema(SKETCHES).parquet(*found).where(F.col("name") == name)
        .agg(F.kll_merge_agg_bigint("sketch").alias("whole"), F.count(F.lit(1)).alias("many"))
        .where("many > 0")
        .select(F.kll_sketch_get_quantile_bigint("whole", ranks).alias("bounds"))
        .first()
    )
    return list(merged.bounds) if merged else None


def measured(df: DataFrame, number: Column, n: int, least: int = 1) -> list[int] | None:
    """Bounds of ``n`` even ranges of the rows themselves; None if there is nothing to cut.

    A pass over all rows that makes the columns of the sort number only. The sketch grows with the
    ranges, so that its error stays a small part of one. Fewer ranges, if they would hold less than
    ``least`` rows.
    """
    if n < 2:
        return None
    k, ranks = min(max(200, 8 * n), 65_535), F.array(*[F.lit(i / n) for i in range(1, n)])
    found = (
        df.select(number.alias("_number"))  # a column of its own is compiled, inside the sketch it is not
        .agg(F.kll_sketch_agg_bigint("_number", k).alias("whole"), F.count(F.lit(1)).alias("many"))
        .where("many > 0")
        .select("many", F.kll_sketch_get_quantile_bigint("whole", ranks).alias("bounds"))
        .first()
    )
    fewer = min(n, -(-found.many // least)) if found else 1
    return [found.bounds[i * n // fewer - 1] for i in range(1, fewer)] or None


def _placed(df: DataFrame, limits: list[int]) -> DataFrame:
    """Adds how many limits lie below ``_number`` (``_low``), and how many below or at it (``_high``).

    One call a row finds its place. A search in steps, each a column, makes a method that the JVM
    leaves uncompiled where there are many limits.
    """
    rounded = sorted(map(float, limits))
    marks = sorted(set(rounded))
    upto = F.array(*[F.lit(k) for k in (0, *(bisect_right(rounded, m) for m in marks))])
    splits = [float("-inf"), *marks, float("inf")]
    found = Bucketizer(splits=splits, inputCol="_number", outputCol="_place").transform(df)
    place = F.col("_place").cast("int")
    at_mark = F.get(F.array(*map(F.lit, marks)), place - 1) == F.col("_number")
    low = F.get(upto, F.when(at_mark, place - 1).otherwise(place))
    return found.withColumns({"_high": F.get(upto, place), "_low": low}).drop("_place")


def deal(df: DataFrame, number: Column, limits: list[int]) -> DataFrame:
    """Rows in ``len(limits) + 1`` partitions by range.

    A number that several bounds share is one with a large share of all rows: it has the ranges
    between them to itself, and its rows are dealt over these by the task they come from, which is
    the same again when a lost task is repeated.
    """
    n = len(limits) + 1
    rows = _placed(df.withColumns({"_number": number.cast("double"), "_task": F.spark_partition_id()}), limits)
    turn = F.pmod(F.xxhash64("_task", F.monotonically_increasing_id() % 1024), F.col("_high") - F.col("_low") + 1)
    rows = rows.withColumn("_range", (F.col("_low") + turn).cast("int"))
    return rows.repartitionById(n, F.col("_range")).drop("_number", "_task", "_low", "_high", "_range")
