"""Removes what has outlived its time: staging loads, and days of the enriched table."""

from __future__ import annotations

import argparse
import datetime as dt
import time

from pyspark.sql import SparkSession

from ratesheet import fixed_values as fv
from ratesheet.session import build_session
from ratesheet.sources import sinks, storage


def expire_loads(
    spark: SparkSession,
    table: str,
    now: float,
    max_age: int = fv.STAGING_EXPIRY_SECONDS,
    enriched: str | None = None,
) -> int:
    """Removes the loads of a table that were written more than ``max_age`` seconds ago.

    With the ``enriched`` table made of it, only those that its ledger has: a load that is not
    enriched yet stays, whatever its age.
    """
    old = {
        storage.qualified(spark, f"{table}/{name}")
        for name, changed in storage.folders(spark, table)
        if name.startswith(f"{sinks.LOAD}=") and changed < now - max_age
    }
    if enriched is not None:
        old &= {row.source for row in sinks.ledger(spark, enriched).collect()}
    return storage.remove(spark, sorted(old))


def drop_days(
    spark: SparkSession, table: str, before: dt.date, column: str = "enriched_date"
) -> int:
    """Removes the day partitions before ``before`` from every load of a table."""
    old = []
    for load, _ in storage.folders(spark, table):
        for name, _ in storage.folders(spark, f"{table}/{load}"):
            key, _, day = name.partition("=")
            if key == column and day[:4].isdigit() and dt.date.fromisoformat(day) < before:
                old.append(f"{table}/{load}/{name}")
    return storage.remove(spark, old)


def main() -> None:
    parser = argparse.ArgumentParser(description="Remove expired staging loads and old days")
    parser.add_argument("--staging-path", required=True)
    parser.add_argument("--enriched-path", required=True)
    parser.add_argument("--keep-days", type=int, default=fv.RAW_RETENTION_DAYS)
    args = parser.parse_args()
    spark = build_session("retention")
    try:
        loads = expire_loads(spark, args.staging_path, time.time(), enriched=args.enriched_path)
        bound = dt.date.today() - dt.timedelta(days=args.keep_days)
        print({"loads": loads, "days": drop_days(spark, args.enriched_path, bound)})
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
