"""Arriving page files -> staging table, then out of the raw prefix."""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ratesheet import fixed_values as fv, schemas
from ratesheet.functions import values
from ratesheet.operators.staging import stage_transform
from ratesheet.session import build_session
from ratesheet.sources import pages, sinks, storage
from ratesheet.sources.named_files import MOVES, moved
from ratesheet.sources.tables import CORRUPT
from ratesheet.streaming.batches import stream_load_id

FILES_PER_BATCH = 10_000


def page_stream(
    spark: SparkSession, root: str, whole_file: bool = True, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """Every object below the raw prefix of ``root`` as it arrives, with its ``file_path``.

    What is no JSON document keeps its text in the column for broken records.
    """
    schema = T.StructType([*schemas.PAGE.fields, T.StructField(CORRUPT, T.StringType(), True)])
    return (
        spark.readStream.schema(schema)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", whole_file)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(f"{root}/{fv.RAW_PREFIX}")
        .withColumn("file_path", F.col("_metadata.file_path"))
    )


def stage_arrivals(
    spark: SparkSession,
    root: str,
    staging_dir: str,
    quarantine_dir: str,
    handled_dir: str,
    checkpoint_dir: str,
    whole_file: bool = True,
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Records of every new page file to staging, unreadable files to quarantine, once.

    Each batch is one load of each table, named after the stream and the batch, so a batch that
    is repeated replaces what it left. A page is parsed once: its records are kept as columns until
    all three are written, not its text. ``handled_dir`` lists the files for ``archive_handled``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        load_id = stream_load_id(batch.sparkSession, checkpoint_dir, batch_id)
        broken = F.col(CORRUPT).isNotNull()
        parsed = batch.select(
            "file_path", "page_number", CORRUPT, F.explode_outer(F.when(~broken, pages.page_records())).alias("record")
        )
        place = f"{staging_dir}/{sinks.INCOMING}/{load_id}.parsed"
        parsed.write.mode("overwrite").parquet(place)
        kept = batch.sparkSession.read.schema(parsed.schema).parquet(place)
        records = kept.where(F.col("record").isNotNull()).select("record.*")
        sinks.write_staging(stage_transform(records), staging_dir, load_id)
        texts = kept.where(broken).select("file_path", "page_number", F.col(CORRUPT).alias("body"))
        sinks.write_load(texts, quarantine_dir, load_id)
        sinks.write_load(kept.select("file_path").distinct(), handled_dir, load_id)
        storage.remove(batch.sparkSession, [place])

    return (
        page_stream(spark, root, whole_file, files_per_batch)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )


def archive_handled(spark: SparkSession, root: str, handled_dir: str, journal_dir: str) -> int:
    """Moves the handled files to the processed prefix; the number moved.

    Run it when the stream has ended: all its batches are committed then. Tasks move the files, and
    each run adds what it has done to the journal, one load a run; names in the journal are not
    looked at again. A run that breaks off leaves no entry: the next one finds some files moved,
    which does no harm, and enters them.
    """
    base = storage.qualified(spark, root)
    if not storage.folders(spark, handled_dir):
        return 0
    names = spark.read.schema("file_path string").parquet(handled_dir)
    named = names.select(pages.object_name(F.col("file_path"), base).alias("old")).where(
        F.startswith("old", F.lit(fv.RAW_PREFIX))
    )
    if storage.folders(spark, journal_dir):
        known = spark.read.schema(MOVES).parquet(journal_dir)
        named = named.join(known.select("old"), "old", "left_anti")
    swapped = values.archive_path(F.col("old")).alias("new")
    done = moved(named.distinct().select("old", swapped), base)
    counts, load_id = Observation("moves"), uuid.uuid4().hex
    sinks.write_load(done.observe(counts, F.count_if("moved").alias("n")), journal_dir, load_id)
    return counts.get["n"]


def main() -> None:
    parser = argparse.ArgumentParser(description="Stage the page files that have arrived")
    for name in ("root", "staging", "quarantine", "handled", "journal", "checkpoint"):
        parser.add_argument(f"--{name}-dir", required=True)
    parser.add_argument("--files-per-batch", type=int, default=FILES_PER_BATCH)
    args = parser.parse_args()
    spark = build_session("arrivals")
    try:
        stage_arrivals(
            spark, args.root_dir, args.staging_dir, args.quarantine_dir, args.handled_dir,
            args.checkpoint_dir, files_per_batch=args.files_per_batch,
        ).awaitTermination()
        print({"files_moved": archive_handled(spark, args.root_dir, args.handled_dir, args.journal_dir)})
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
