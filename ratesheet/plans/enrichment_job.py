"""Staging loads -> enriched table, each load once."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import Observation, SparkSession, functions as F

from ratesheet.operators.enrichment import enrich
from ratesheet.session import build_session
from ratesheet.sources import sinks, storage, tables

#: Rows of a range of the output, which a task sorts at once.
ROWS_PER_RANGE = 500_000


def pending(spark: SparkSession, staging_path: str, enriched_path: str) -> list[str]:
    """Staging loads that the ledger of the enriched table does not have."""
    loads = sinks.load_dirs(spark, staging_path)
    named = [(load, storage.qualified(spark, load)) for load in loads]
    if not named:
        return []
    left = spark.createDataFrame(named, "load string, source string").join(
        sinks.ledger(spark, enriched_path), "source", "left_anti"
    )
    return sorted(row.load for row in left.select("load").collect())


def run(
    spark: SparkSession,
    staging_path: str,
    enriched_path: str,
    run_ts: dt.datetime | None = None,
    by: str = "enriched_date",
    load_id: str | None = None,
) -> dict[str, int]:
    """Enrich the staging loads that are not enriched yet and add them as one load.

    Returns the row count, observed during the write itself. The names of the staging loads are
    published with the rows, so a run that breaks off leaves neither, and a run that finds nothing
    new adds nothing. A load is named after its run time unless the caller names it.

    The output is cut into as many ranges as the input has splits, or into more where these hold
    more than ``ROWS_PER_RANGE`` rows: files are packed, and a task sorts rows unpacked.
    """
    loads = pending(spark, staging_path, enriched_path)
    if not loads:
        return {"rows_written": 0}
    counts = Observation("enrichment")
    staged = tables.read_staging_loads(spark, loads)
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    clock = F.lit(run_ts.isoformat(sep=" ")).cast("timestamp")
    load_id = load_id or f"{run_ts:%Y%m%dT%H%M%S.%f}"
    n = max(staged.rdd.getNumPartitions(), -(-staged.count() // ROWS_PER_RANGE))
    rows = enrich(staged, clock)
    sinks.write_enriched(rows, enriched_path, load_id, by=by, n=n, counts=counts, sources=loads)
    return counts.get


def main() -> None:
    parser = argparse.ArgumentParser(description="Enrich the staging table")
    parser.add_argument("--staging-path", required=True)
    parser.add_argument("--enriched-path", required=True)
    layouts = ["enriched_date", "effective_quarter"]
    parser.add_argument("--partition-by", default=layouts[0], choices=layouts)
    parser.add_argument("--load-id", help="default: the run time")
    args = parser.parse_args()
    spark = build_session("enrichment")
    try:
        print(run(spark, args.staging_path, args.enriched_path, by=args.partition_by, load_id=args.load_id))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
