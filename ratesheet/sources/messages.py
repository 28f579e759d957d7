"""Topic messages: base64-encoded JSON in a ``value`` column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ratesheet import schemas


def message_text(value: Column) -> Column:
    """Decoded text; null for a value that is not base64."""
    return F.try_to_binary(value, F.lit("base64")).cast("string")


def encode(text: Column) -> Column:
    """Base64 on one line (the built-in function may break it every 76 characters)."""
    return F.translate(F.base64(text.cast("binary")), "\r\n", "")


def decode_readings(messages: DataFrame, value: str = "value") -> DataFrame:
    """Sensor readings of the messages, with the message as it was ``sent``, its text ``body``
    and what the temperature field held as text. A number sent as text is a number; a
    temperature may be present without being one."""
    text = message_text(F.col(value))
    readings = (
        messages.withColumn("body", text)
        .withColumn("_reading", F.from_json("body", schemas.SENSOR))
        .withColumn("temperature_text", F.get_json_object("body", "$.temperature"))
        .select("*", "_reading.*")
        .drop("_reading")
        .withColumnRenamed(value, "sent")
    )
    number = F.coalesce("temperature", F.col("temperature_text").try_cast("double"))
    return readings.withColumn("temperature", number)


def is_object(text: Column) -> Column:
    """Whether a text is a JSON object."""
    return F.coalesce(
        F.try_parse_json(text).isNotNull() & F.startswith(F.ltrim(text), F.lit("{")), F.lit(False)
    )


def decode_notifications(messages: DataFrame, value: str = "value") -> DataFrame:
    text = message_text(F.col(value))
    return messages.withColumn("_n", F.from_json(text, schemas.NOTIFICATION)).select(
        *[c for c in messages.columns if c != value], "_n.*"
    )
