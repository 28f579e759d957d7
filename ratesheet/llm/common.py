"""Helpers that several operators share: written tables, a bounded bitmap filter, words."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ratesheet.session import shared_dir
from ratesheet.sources import storage

#: Bits of the bitmap filter: 1 MB whatever the data's size.
BITMAP_BITS = 1 << 23
_CHUNK_BITS = 32_768  # bits of one bitmap that bitmap_construct_agg builds

#: Byte -> itself if it is part of a plain word, lower-cased; else a space.
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
    for c in range(256)
)


def plain_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of ASCII letters and digits and of code points beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(_PLAIN).split() if isinstance(text, str) else []


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: cuts the lineage for good.

    Its shuffle files go with the write, so only one step's are on disk at a time.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    with storage.freed_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Removes the tables from ``written`` that these read; nothing may read them any more."""
    for table in tables:
        folders = {file.rsplit("/", 1)[0] for file in table.inputFiles()}
        storage.remove(table.sparkSession, [f for f in folders if re.search(r"/ratesheet/[0-9a-f]{32}/\w+$", f)])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bucket_of(column: str, modulus: int) -> Column:
    """crc32 of the number as text, modulo ``modulus``; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def with_maybe(df: DataFrame, column: str, keys: DataFrame, flag: str = "_maybe") -> DataFrame:
    """Adds ``flag``: false where ``column`` is surely not among the one column of ``keys``.

    A bitmap of ``BITMAP_BITS`` bits in pieces of 4,096 small numbers goes to every task, 2 MB in
    all for any number of keys. It only spares a shuffle: true may be wrong, so an exact join must follow.
    """
    (key,) = keys.columns
    bitmaps = (
        keys.select(F.pmod(F.xxhash64(key), F.lit(BITMAP_BITS)).alias("_p"))
        .groupBy(F.expr(f"_p div {_CHUNK_BITS}").alias("_chunk"))
        .agg(F.bitmap_construct_agg(F.col("_p") % _CHUNK_BITS).alias("_bits"))
    )
    # As an array a byte is read in place; out of a binary, all of its bytes are copied for each row.
    byte = "cast(conv(hex(substring(_bits, i + 1, 1)), 16, 10) as smallint)"
    bitmaps = bitmaps.select("_chunk", F.expr(f"transform(sequence(0, {_CHUNK_BITS // 8 - 1}), i -> {byte})").alias("_bits"))
    bit = F.getbit(F.expr(f"get(_bits, int(_p % {_CHUNK_BITS} div 8))").cast("bigint"), (F.col("_p") % 8).cast("int"))
    return (
        df.withColumn("_p", F.pmod(F.xxhash64(column), F.lit(BITMAP_BITS)))
        .withColumn("_chunk", F.expr(f"_p div {_CHUNK_BITS}"))
        .join(F.broadcast(bitmaps), "_chunk", "left")
        .withColumn(flag, F.col(column).isNotNull() & (F.coalesce(bit, F.lit(0)) == 1))
        .drop("_p", "_chunk", "_bits")
    )


def importable(df: DataFrame) -> DataFrame:
    """``df``; Python workers started for it also look for this package where the driver found it.

    That serves sessions on one machine whose driver runs from elsewhere. A cluster has the
    package installed or given with --py-files.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = df.sparkSession.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*filter(None, known), root])
    return df


def over_texts(
    df: DataFrame,
    columns: list[str],
    schema: str,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
) -> DataFrame:
    """``fn`` on Arrow batches of the named columns; each row stands for itself."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return importable(df).select(*columns).mapInPandas(run, schema)
