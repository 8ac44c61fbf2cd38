"""Topic sinks: Kafka, or folders of Parquet files shaped like the records a topic source reads.

Folder form: ``<path>/_topic=<topic>/_batch=<writer>-<n>/``. Every writer, stream or
batch, writes this way, so jobs may share a root and one job's topic feeds the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Delivery settings of the producer.
PRODUCER = {"kafka.acks": "all", "kafka.enable.idempotence": "true"}


def kafka_options(servers: str, **extra: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, **PRODUCER, **extra}


def _records(messages: DataFrame) -> DataFrame:
    """A keyed message goes to its key's partition; without a key the sink spreads them."""
    key = F.col("key") if "key" in messages.columns else F.lit(None)
    return messages.select("topic", key.cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def stream_to_kafka(messages: DataFrame, servers: str, checkpoint: str, **trigger) -> StreamingQuery:
    writer = _records(messages).writeStream.format("kafka").options(**kafka_options(servers))
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def batch_to_kafka(messages: DataFrame, servers: str) -> None:
    _records(messages).write.format("kafka").options(**kafka_options(servers)).save()


def batch_to_files(messages: DataFrame, path: str, batch: str) -> None:
    """Write one batch below its own ``_batch`` folders; a replay replaces them.

    Records get a position within the batch and the time they are written.
    """
    records = _records(messages).select(
        "key",
        "value",
        "topic",
        F.lit(0).alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        F.current_timestamp().alias("timestamp"),
        F.col("topic").alias("_topic"),
        F.lit(batch).alias("_batch"),
    )
    (
        records.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("_topic", "_batch")
        .parquet(path)
    )
