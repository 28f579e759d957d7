"""Cut a table into numbered pages of a fixed size, without a global sort.

Records are ordered by the MD5 of their JSON text. Its first hex digits (``slot_digits``, four
unless the caller says otherwise: 65,536 slots) are an even split of that order whatever the data
looks like, so a record's row number is (rows in earlier slots) + (rows before it in its slot).
Copies are counted before anything is ordered: a record with a billion copies is one line until its
pages are written out. Counting moves hashes alone.

Pages are put together in blocks of neighbouring slots, some twenty pages each. A record's text moves once, to its block, where
all pages that lie inside the block are made; only what belongs to a page at a block's edge, or fills
a page alone, moves on to its page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ratesheet import fixed_values as fv
from ratesheet.functions import values

SLOT_DIGITS = 4
#: Pages that a block of slots holds, unless a slot alone has more.
BLOCK_PAGES = 20
#: Copies from which a record moves as one line; their hashes go to all tasks, one of this many rows at most.
HEAVY_COPIES = 10_000


def record_json(columns: list[str]) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def numbered_runs(df: DataFrame, columns: list[str], slot_digits: int = SLOT_DIGITS) -> DataFrame:
    """Distinct records with their ``copies`` and the row number (from 0) of the first."""
    records = df.select(record_json(columns).alias("record")).withColumn("sort_key", F.md5("record"))
    # Never null, and known as such: otherwise the join below pushes a null test on this
    # expression down to the source rows and keeps the two uses from sharing one shuffle.
    slot = F.coalesce(F.substring("sort_key", 1, slot_digits), F.lit(""))
    runs = records.groupBy("sort_key").agg(F.count(F.lit(1)).alias("copies")).withColumn("slot", slot)
    earlier = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    # At most 16**slot_digits rows: the window and the broadcast are bounded.
    slot_starts = (
        runs.groupBy("slot")
        .agg(F.sum("copies").alias("n"))
        .select("slot", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("slot_start"))
    )
    within = Window.partitionBy("slot").orderBy("sort_key").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("slot_start") + F.coalesce(F.sum("copies").over(within), F.lit(0))
    numbers = runs.join(F.broadcast(slot_starts), "slot").select("sort_key", "copies", start.alias("start"))
    texts = records.groupBy("sort_key").agg(F.any_value("record").alias("record"))
    return texts.join(numbers, "sort_key").select("record", "copies", "start")


def block_runs(df: DataFrame, columns: list[str], slot_digits: int, block_rows: int, heavy: int) -> DataFrame:
    """Records with their block, ``copies``, the row number (from 0) of the first, and the block's own rows.

    A block is made of whole slots, with about ``block_rows`` rows. Lines of one record may stand for
    one copy each, if it has less than ``heavy``.
    """
    key = F.md5("record")
    # Never null, and known as such: see above.
    sort_key = F.coalesce(F.unhex(key), F.lit(b""))
    slot = F.coalesce(F.substring(key, 1, slot_digits), F.lit(""))
    records = df.select(record_json(columns).alias("record")).select(
        "record", sort_key.alias("sort_key"), slot.alias("slot")
    )
    counts = records.groupBy("sort_key", "slot").agg(F.count(F.lit(1)).alias("copies"))
    upto = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    block = Window.partitionBy("block")
    # At most 16**slot_digits rows: the windows and the broadcast are bounded.
    slots = (
        counts.groupBy("slot")
        .agg(F.sum("copies").alias("n"))
        .withColumn("end", F.sum("n").over(upto))
        .withColumn("block", F.expr(f"(end - n) div {block_rows}"))
        .select(
            "slot", "block",
            F.min(F.col("end") - F.col("n")).over(block).alias("block_start"),
            F.max("end").over(block).alias("block_end"),
        )
    )
    many = F.broadcast(counts.where(F.col("copies") >= heavy).select("sort_key", "copies"))
    single = records.join(many, "sort_key", "left_anti").select("slot", "record", F.lit(1).cast("bigint").alias("copies"))
    whole = (
        records.join(many, "sort_key")
        .groupBy("sort_key", "slot", "copies")
        .agg(F.any_value("record").alias("record"))
        .select("slot", "record", "copies")
    )
    # As many parts as the cluster is set to: joined ones would be sorted in fewer, larger tasks.
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = single.unionByName(whole).join(F.broadcast(slots), "slot").drop("slot").repartition(n, "block")
    # The hash is made again behind the shuffle: it would be a fifth of what is moved.
    within = Window.partitionBy("block").orderBy("sort_key").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("copies").over(within), F.lit(0))
    return placed.withColumn("sort_key", sort_key).select(
        "block", "block_start", "block_end", "record", "copies", (F.col("block_start") + before).alias("start")
    )


def page_contents(
    df: DataFrame,
    columns: list[str],
    page_size: int = fv.PAGE_SIZE,
    slot_digits: int = SLOT_DIGITS,
    heavy: int = HEAVY_COPIES,
) -> DataFrame:
    """One row per page: number from 1, record count, records as a JSON list."""
    first = F.col("start")
    end = F.col("start") + F.col("copies")
    pages = f"sequence(start div {page_size}, (start + copies - 1) div {page_size})"
    page_start, page_end = F.col("page") * page_size, (F.col("page") + 1) * page_size
    repeat = F.least(end, page_end) - F.greatest(first, page_start)
    inside = (page_start >= F.col("block_start")) & (page_end <= F.col("block_end"))
    pieces = (
        block_runs(df, columns, slot_digits, BLOCK_PAGES * page_size, max(heavy, page_size))
        .withColumn("page", F.explode(F.expr(pages)))
        .select("block", "page", "start", "record", repeat.cast("int").alias("repeat"), inside.alias("inside"))
    )
    # A page that one record fills is put together elsewhere: a block may have any number of them.
    local = F.col("inside") & (F.col("repeat") < page_size)
    made = _assembled(pieces.where(local), "block", "page")
    return made.unionByName(_assembled(pieces.where(~local), "page"))


def _assembled(pieces: DataFrame, *groups: str) -> DataFrame:
    # A group is one page: at most page_size records.
    ordered = F.sort_array(F.collect_list(F.struct("start", "repeat", "record")))
    texts = F.flatten(F.transform("runs", lambda r: F.array_repeat(r["record"], r["repeat"])))
    return (
        pieces.groupBy(*groups)
        .agg(F.sum("repeat").alias("records_count"), ordered.alias("runs"))
        .select(
            (F.col("page") + 1).alias("page_number"),
            "records_count",
            F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]")).alias("records"),
        )
    )


def page_parts(
    df: DataFrame,
    columns: list[str],
    extracted_at: Column,
    page_size: int = fv.PAGE_SIZE,
    endpoint: str = "",
    slot_digits: int = SLOT_DIGITS,
) -> DataFrame:
    """Pages with what their envelope says: ``head`` is the JSON text that stands before the records."""
    page = F.col("page_number")
    offset = (page - 1) * page_size
    head = F.to_json(
        F.struct(
            F.date_format(extracted_at, "yyyy-MM-dd'T'HH:mm:ss").alias("extraction_timestamp"),
            F.lit(fv.PAGE_SOURCE).alias("source"),
            F.lit(endpoint).alias("api_endpoint"),
            "page_number",
            offset.alias("offset"),
            F.lit(page_size).alias("limit"),
            "records_count",
            F.struct(F.lit(page_size).alias("limit"), offset.alias("offset")).alias("parameters"),
        )
    )
    return page_contents(df, columns, page_size, slot_digits).select(
        "page_number",
        offset.alias("offset"),
        F.lit(page_size).alias("limit"),
        "records_count",
        values.page_file_name(page, extracted_at).alias("file_name"),
        "records",
        F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"data":{"results":')).alias("head"),
    )


def with_bodies(parts: DataFrame) -> DataFrame:
    """Page parts with their JSON body and its size in bytes."""
    body = F.concat("head", "records", F.lit("}}"))
    size = F.octet_length("head") + F.octet_length("records") + 2
    return parts.select(
        "page_number", "offset", "limit", "records_count", "file_name", "records",
        body.alias("body"), size.alias("file_size_bytes"),
    )


def page_envelopes(
    df: DataFrame,
    columns: list[str],
    extracted_at: Column,
    page_size: int = fv.PAGE_SIZE,
    endpoint: str = "",
    slot_digits: int = SLOT_DIGITS,
) -> DataFrame:
    """Pages with their envelope: file name, JSON body and its size in bytes."""
    return with_bodies(page_parts(df, columns, extracted_at, page_size, endpoint, slot_digits))


def page_totals(pages: DataFrame) -> DataFrame:
    """Files written, records in them, highest page number."""
    return pages.agg(
        F.count(F.lit(1)).alias("total_files_created"),
        F.sum("records_count").alias("total_records"),
        F.max("page_number").alias("pages_processed"),
    )
