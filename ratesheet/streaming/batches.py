"""Names for the loads that a stream's batches leave."""

from __future__ import annotations

from pyspark.sql import SparkSession


def stream_load_id(spark: SparkSession, checkpoint_dir: str, batch_id: int) -> str:
    """The stream's own id, from its checkpoint, and the number of the batch. A stream that
    starts over with a new checkpoint has a new id and so replaces nothing."""
    stream = spark.read.schema("id string").json(f"{checkpoint_dir}/metadata").first().id
    return f"{stream}-{batch_id:09d}"
