"""Sensor readings: cleaning, scoring, daily summary, message validation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ratesheet import fixed_values as fv


_MEASURES = {"avg": F.avg, "max": F.max, "min": F.min, "count_if": F.count_if, "count": F.count}


def clean(readings: DataFrame) -> DataFrame:
    """Readings with a temperature inside the accepted range."""
    return readings.where(
        F.col("temperature").isNotNull() & F.col("temperature").between(*fv.TEMPERATURE_RANGE)
    )


def process(readings: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Clean, score and flag readings; a null input scores low."""
    good = (
        F.col("temperature").between(*fv.GOOD_TEMPERATURE)
        & F.col("humidity").between(*fv.GOOD_HUMIDITY)
        & F.col("pressure").between(*fv.GOOD_PRESSURE)
    )
    return (
        clean(readings)
        .withColumns(
            {
                "quality_score": F.when(good, fv.GOOD_SCORE).otherwise(fv.POOR_SCORE),
                "anomaly_detected": F.col("temperature") > fv.ANOMALY_ABOVE,
                "processing_timestamp": F.current_timestamp() if run_ts is None else run_ts,
            }
        )
        .withColumnsRenamed({m: f"avg_{m}" for m in ("temperature", "humidity", "pressure")})
    )


def daily_summary(processed: DataFrame, day: dt.date, time_col: str = "timestamp") -> DataFrame:
    """Per-location measures of one day. The day is a half-open range on the raw
    timestamp, which reaches the scan; a formatted-date comparison would not."""
    start = F.lit(day).cast(processed.schema[time_col].dataType)
    end = F.lit(day + dt.timedelta(days=1)).cast(processed.schema[time_col].dataType)
    return (
        processed.where((F.col(time_col) >= start) & (F.col(time_col) < end))
        .groupBy("location")
        .agg(*[_MEASURES[how](c).alias(name) for name, how, c in fv.DAILY_MEASURES])
        .withColumn("date", F.lit(day))
    )


SUMMARY_COLUMNS = [name for name, *_ in fv.DAILY_MEASURES]


def metric_rows(summary: DataFrame, *keep: str) -> DataFrame:
    """Daily summary as generic metric rows with a JSON detail column, plus ``keep``."""
    return summary.select(
        "date",
        F.lit(fv.METRIC_NAME).alias("metric_name"),
        F.col("daily_avg_temperature").alias("metric_value"),
        F.lit(fv.METRIC_CATEGORY).alias("category"),
        F.col("location").alias("subcategory"),
        F.to_json(F.struct(*SUMMARY_COLUMNS)).alias("metadata"),
        *keep,
    )


def validate(
    readings: DataFrame, time_col: str = "timestamp", present: dict[str, Column] | None = None
) -> DataFrame:
    """Add ``errors`` (array of messages) and ``is_valid``.

    ``present`` overrides how the presence of a field is tested: a message may carry a
    temperature that is there but not numeric, which passes and skips the range test.
    """
    columns = {"timestamp": time_col}
    checks = [
        F.when(
            ~(present or {}).get(name, F.col(columns.get(name, name)).isNotNull()),
            F.lit(fv.MISSING_FIELD_TEXT + name),
        )
        for name in fv.REQUIRED_FIELDS
    ]
    checks.append(
        F.when(~F.col("temperature").between(*fv.TEMPERATURE_RANGE), F.lit(fv.OUT_OF_RANGE_TEXT))
    )
    checked = readings.withColumn("errors", F.array_compact(F.array(*checks)))
    return checked.withColumn("is_valid", F.size("errors") == 0)


def error_payloads(validated: DataFrame, original: Column, sent_time: Column) -> DataFrame:
    """JSON payload of every rejected record: the record, its errors, its time.

    ``original`` is the record's text and goes in as the object it is; a text that is no JSON
    goes in as a string. ``sent_time`` is the JSON value of the record's own time, if any.
    """
    quoted = F.regexp_extract(F.to_json(F.struct(original.alias("v"))), r'^\{"v":(.*)\}$', 1)
    record = F.when(F.try_parse_json(original).isNotNull(), original).otherwise(quoted)
    null = F.lit("null")
    payload = F.concat(
        F.lit('{"original_data":'), F.coalesce(F.nullif(record, F.lit("")), null),
        F.lit(',"errors":'), F.to_json("errors"),
        F.lit(',"timestamp":'), F.coalesce(sent_time, null), F.lit("}"),
    )
    return validated.where(~F.col("is_valid")).select(payload.alias("value"))


def message_rows(readings: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """A decoded message as a processed row, with constant score and flag."""
    return readings.withColumns(
        {
            "quality_score": F.lit(fv.MESSAGE_SCORE),
            "anomaly_detected": F.lit(False),
            "processing_timestamp": F.current_timestamp() if run_ts is None else run_ts,
        }
    ).withColumnsRenamed({m: f"avg_{m}" for m in ("temperature", "humidity", "pressure")})


def alert_lines(notifications: DataFrame) -> DataFrame:
    """One formatted line per notification; missing fields take their defaults."""
    return notifications.withColumn(
        "line",
        F.format_string(
            fv.ALERT_FORMAT,
            F.upper(F.coalesce("severity", F.lit(fv.ALERT_SEVERITY))),
            F.coalesce("type", F.lit(fv.ALERT_TYPE)),
            F.coalesce("message", F.lit(fv.ALERT_MESSAGE)),
        ),
    )
