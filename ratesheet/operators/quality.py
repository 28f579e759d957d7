"""Monitoring: freshness, error rate, null checks, retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ratesheet import fixed_values as fv


def _since(df: DataFrame, time_col: str, as_of: dt.datetime, age: dt.timedelta) -> DataFrame:
    bound = F.lit((as_of - age).isoformat(sep=" ")).cast(df.schema[time_col].dataType)
    return df.where(F.col(time_col) >= bound)


def freshness(df: DataFrame, time_col: str, as_of: dt.datetime, name: str) -> DataFrame:
    """Newest time and row count of the last day; stale when there is no row."""
    recent = _since(df, time_col, as_of, dt.timedelta(hours=fv.FRESH_HOURS))
    found = recent.agg(F.max(time_col).alias("latest"), F.count(F.lit(1)).alias("n_rows"))
    stale = (F.col("n_rows") == 0).alias("is_stale")
    return found.select(F.lit(name).alias("table_name"), "latest", "n_rows", stale)


def error_rate(df: DataFrame, status_col: str, time_col: str, as_of: dt.datetime) -> DataFrame:
    """Rows and share per status over the last day; alert on a high share of errors.

    The total is a scalar subquery over the same counts, so no window gathers the
    statuses in one task.
    """
    recent = _since(df, time_col, as_of, dt.timedelta(hours=fv.FRESH_HOURS))
    status = F.col(status_col).alias("status")
    counts = recent.groupBy(status).agg(F.count(F.lit(1)).alias("n_rows"))
    total = counts.agg(F.sum("n_rows")).scalar()
    share = F.round(F.col("n_rows").cast("double") * 100.0 / total, 6)
    alert = (F.col("status") == fv.ERROR_STATUS) & (F.col("percentage") > fv.ERROR_LIMIT_PERCENT)
    return counts.withColumn("percentage", share).withColumn(
        "is_alert", F.coalesce(alert, F.lit(False))
    )


def null_violations(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Rows with a null in any of the columns; the check passes at zero."""
    broken = F.lit(False)
    for c in columns:
        broken = broken | F.col(c).isNull()
    return df.agg(F.count_if(broken).alias("violations")).select(
        F.lit(name).alias("table_name"), "violations", (F.col("violations") == 0).alias("passed")
    )


def retain(df: DataFrame, time_col: str, as_of: dt.datetime, max_age: dt.timedelta) -> DataFrame:
    """Rows no older than ``max_age``; on a table partitioned by time the rest is pruned."""
    return _since(df, time_col, as_of, max_age)


def query_log_summary(
    log: DataFrame, elapsed: Column, answer: Column, sources: Column
) -> DataFrame:
    """Question count, mean time, mean answer length and mean number of sources."""
    return log.agg(
        F.count(F.lit(1)).alias("n_queries"),
        F.avg(elapsed).alias("avg_seconds"),
        F.avg(F.length(answer)).alias("avg_answer_chars"),
        F.avg(sources).alias("avg_sources"),
    )
