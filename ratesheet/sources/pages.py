"""Page files and API replies: reading, and finding the records inside."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ratesheet import fixed_values as fv, schemas
from ratesheet.sources import storage

RECORDS = T.ArrayType(schemas.RECORD)


def read_pages(spark: SparkSession, path: str, whole_file: bool = True) -> DataFrame:
    """Page files below ``path``. Each is one JSON document; ``whole_file=False`` reads one page a line."""
    reader = spark.read.schema(schemas.PAGE).option("recursiveFileLookup", True)
    return reader.option("multiLine", whole_file).json(path)


def plain_root(path: str) -> str:
    """A qualified path with one slash after its scheme, as ``object_name`` compares it."""
    return re.sub("^([a-z0-9]+):/+", r"\1:/", path)


def object_name(file_path: Column, root: str) -> Column:
    """Name of an object relative to the qualified ``root``; null outside of it."""
    plain = F.regexp_replace(F.url_decode(file_path), "^([a-z0-9]+):/+", "$1:/")
    below = plain_root(root).rstrip("/") + "/"
    return F.when(plain.startswith(below), F.substring(plain, F.lit(len(below) + 1), F.length(plain)))


def only_raw(df: DataFrame, root: str, prefix: str = fv.RAW_PREFIX) -> DataFrame:
    """Rows that came from an object whose name below ``root`` starts with the raw prefix."""
    name = object_name(F.col("_metadata.file_path"), storage.qualified(df.sparkSession, root))
    return df.where(F.coalesce(F.startswith(name, F.lit(prefix)), F.lit(False)))


def _is_list(json_text: Column) -> Column:
    return F.ltrim(json_text).startswith("[")


def _holder_list(holder: Column) -> Column:
    """List text of a payload holder: no ``results`` key is an empty list; a ``results``
    that is no list gives null, so that the next shape is tried."""
    results = holder["results"]
    return F.when(
        holder.isNotNull(),
        F.when(~F.map_contains_key(holder, "results"), "[]").when(_is_list(results), results),
    )


def records_text(data: Column, raw_response: Column, results: Column) -> Column:
    """JSON list of the first payload shape that is a list, even an empty one."""
    return F.coalesce(
        _holder_list(data),
        _holder_list(raw_response),
        F.when(_is_list(results), results),
        F.lit("[]"),
    )


def page_records() -> Column:
    """The records of a page, in the first payload shape that is a list."""
    return F.from_json(records_text(F.col("data"), F.col("raw_response"), F.col("results")), RECORDS)


def extract_records(pages: DataFrame, *keep: str) -> DataFrame:
    """One row per record of every page, plus the ``keep`` columns of the page."""
    return pages.select(*keep, F.explode(page_records()).alias("r")).select(*keep, "r.*")


def locate_records(replies: DataFrame, body: str, *keep: str) -> DataFrame:
    """One row per record of a raw API reply.

    A list reply holds the records itself. Otherwise the first of ``results``, ``data``,
    ``records`` that is *present* counts; if that is empty, the first non-empty of ``items``,
    ``rows``, ``entries``, ``content``.
    """
    text = F.col(body)
    reply = F.from_json(F.when(~_is_list(text), text), T.MapType(T.StringType(), T.StringType()))

    def as_list(json_text: Column) -> Column:
        return F.from_json(F.when(_is_list(json_text), json_text), RECORDS)

    present = F.lit(None).cast("string")
    for key in reversed(fv.REPLY_KEYS):
        present = F.when(F.map_contains_key("_reply", key), F.col("_reply")[key]).otherwise(present)
    # A non-empty value that is no list ends the search without records.
    other = present.isNotNull() & ~_is_list(present) & ~present.isin("{}", "", "0", "false")
    fallbacks = [as_list(F.col("_reply")[key]) for key in fv.REPLY_FALLBACK_KEYS]
    records = (
        F.when(_is_list(text), as_list(text))
        .when(F.size(as_list(present)) > 0, as_list(present))
        .when(~other, F.coalesce(*[F.when(F.size(found) > 0, found) for found in fallbacks]))
    )
    return (
        replies.withColumn("_reply", reply)
        .select(*keep, F.explode(records).alias("r"))
        .select(*keep, "r.*")
    )
