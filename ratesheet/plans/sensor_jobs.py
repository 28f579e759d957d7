"""Sensor JSON -> processed table, and processed table -> daily metric rows."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import Column, Observation, SparkSession, functions as F

from ratesheet import schemas
from ratesheet.operators import sensor
from ratesheet.session import build_session
from ratesheet.sources import sinks, tables


def process(
    spark: SparkSession,
    input_glob: str,
    processed_path: str,
    load_id: str,
    run_ts: Column | None = None,
    whole_file: bool = True,
) -> dict[str, int]:
    """Clean, score and add the readings of the input files as one load; returns the row
    counts, observed while the rows are written. A repeated load replaces itself."""
    read, written = Observation("read"), Observation("written")
    readings = tables.read_sensor(spark, input_glob, whole_file)
    readings = readings.observe(read, F.count(F.lit(1)).alias("rows_read"))
    rows = sensor.process(readings, run_ts).select(*schemas.PROCESSED_SENSOR.fieldNames())
    rows = rows.observe(written, F.count(F.lit(1)).alias("rows_written"))
    sinks.write_load(rows, processed_path, load_id)
    return {**read.get, **written.get}


def summarise_day(spark: SparkSession, processed_path: str, daily_path: str, day: dt.date) -> None:
    """Write the metric rows of one day, replacing that day only."""
    processed = tables.read_processed_sensor(spark, processed_path)
    sinks.write_daily(sensor.metric_rows(sensor.daily_summary(processed, day)), daily_path)


def main() -> None:
    parser = argparse.ArgumentParser(description="Sensor jobs")
    jobs = parser.add_subparsers(dest="job", required=True)
    one = jobs.add_parser("process")
    one.add_argument("--input", required=True)
    one.add_argument("--processed-path", required=True)
    one.add_argument("--load-id", required=True)
    two = jobs.add_parser("daily")
    two.add_argument("--processed-path", required=True)
    two.add_argument("--daily-path", required=True)
    two.add_argument("--day", type=dt.date.fromisoformat, help="default: yesterday")
    args = parser.parse_args()
    spark = build_session("sensor")
    try:
        if args.job == "process":
            print(process(spark, args.input, args.processed_path, args.load_id))
        else:
            day = args.day or dt.date.today() - dt.timedelta(days=1)
            summarise_day(spark, args.processed_path, args.daily_path, day)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
