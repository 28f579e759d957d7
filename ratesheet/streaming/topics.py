"""Sensor topic: validation and routing, processing, alerts, archive.

Sinks inside ``foreachBatch`` write each batch as a load of its own, named after the stream and
the batch, so a batch that is repeated after a failure leaves no duplicates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ratesheet import fixed_values as fv, schemas
from ratesheet.operators import sensor
from ratesheet.sources import messages, sinks
from ratesheet.streaming.batches import stream_load_id


def message_stream(spark: SparkSession, topic_dir: str) -> DataFrame:
    """Messages as lines of base64 text. Any source with a ``value`` column fits here."""
    return spark.readStream.text(topic_dir)


def _start(df: DataFrame, checkpoint_dir: str, **sink) -> StreamingQuery:
    writer = df.writeStream.option("checkpointLocation", checkpoint_dir).trigger(availableNow=True)
    if "each" in sink:
        return writer.foreachBatch(sink["each"]).start()
    return writer.format(sink["format"]).option("path", sink["path"]).outputMode("append").start()


def _loads(checkpoint_dir: str, write: Callable[[DataFrame, str], None]):
    """``write`` with the batch and the name of its load, the batch kept meanwhile."""

    def each(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        write(kept, stream_load_id(batch.sparkSession, checkpoint_dir, batch_id))
        kept.unpersist()

    return each


def validated(stream: DataFrame) -> DataFrame:
    """Decoded readings with ``errors`` and ``is_valid``.

    A field is present if the message holds it, whatever its form. A message that is not readable
    lacks every required field and so is invalid too.
    """
    present = {c: F.get_json_object("body", f"$.{c}").isNotNull() for c in fv.REQUIRED_FIELDS}
    return sensor.validate(messages.decode_readings(stream), present=present)


def error_payloads(checked: DataFrame) -> DataFrame:
    return sensor.error_payloads(checked, F.coalesce("body", "sent"), _sent_time())


def _sent_time() -> Column:
    return F.expr("to_json(try_variant_get(try_parse_json(body), '$.timestamp', 'variant'))")


def route_messages(
    spark: SparkSession, topic_dir: str, valid_dir: str, error_dir: str, checkpoint_dir: str
) -> StreamingQuery:
    """Valid messages to one topic folder, error payloads to the other."""

    def write(batch: DataFrame, load_id: str) -> None:
        checked = validated(batch)
        good = checked.where("is_valid").select(messages.encode(F.col("body")).alias("value"))
        good.write.mode("overwrite").text(sinks.load_dir(valid_dir, load_id))
        error_payloads(checked).write.mode("overwrite").text(sinks.load_dir(error_dir, load_id))

    return _start(message_stream(spark, topic_dir), checkpoint_dir, each=_loads(checkpoint_dir, write))


def process_messages(
    spark: SparkSession, topic_dir: str, table_dir: str, error_dir: str, checkpoint_dir: str
) -> StreamingQuery:
    """Readable messages as rows of the processed table; the others to the error side."""

    def write(batch: DataFrame, load_id: str) -> None:
        decoded = messages.decode_readings(batch.select("value"))
        readable = messages.is_object(F.col("body"))
        rows = sensor.message_rows(decoded.where(readable))
        sinks.write_load(rows.select(*schemas.PROCESSED_SENSOR.fieldNames()), table_dir, load_id)
        checked = validated(batch.select("value")).where(~readable)
        error_payloads(checked).write.mode("overwrite").text(sinks.load_dir(error_dir, load_id))

    return _start(message_stream(spark, topic_dir), checkpoint_dir, each=_loads(checkpoint_dir, write))


def alert_messages(
    spark: SparkSession, topic_dir: str, alert_dir: str, checkpoint_dir: str
) -> StreamingQuery:
    """Notification messages as formatted lines of an alert table."""
    decoded = messages.decode_notifications(message_stream(spark, topic_dir).select("value"))
    return _start(sensor.alert_lines(decoded), checkpoint_dir, format="parquet", path=alert_dir)


def process_and_archive(
    spark: SparkSession,
    topic_dir: str,
    table_dir: str,
    error_dir: str,
    archive_dir: str,
    checkpoint_dir: str,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Two subscribers of one topic, each with its own progress."""
    processed = process_messages(spark, topic_dir, table_dir, error_dir, f"{checkpoint_dir}/process")
    raw = message_stream(spark, topic_dir).select(
        "value", F.current_timestamp().alias("received_at")
    )
    archived = _start(raw, f"{checkpoint_dir}/archive", format="parquet", path=archive_dir)
    return processed, archived
