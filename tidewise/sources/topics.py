"""Topic sources: Kafka, or a folder of Parquet files shaped like Kafka records."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TOPIC_RECORD


#: Bytes of messages, not yet compressed, that a landed file holds in one piece: what a task reads at least. A batch of
#: a few files is read by as many tasks as it has pieces.
ROW_GROUP = 8 << 20


def starting_offsets(positions: Mapping[tuple[str, int], int]) -> str:
    """Stored positions, (topic, partition) -> next offset, as the option Spark takes."""
    topics: dict[str, dict[str, int]] = {}
    for (topic, partition), offset in sorted(positions.items()):
        topics.setdefault(topic, {})[str(partition)] = offset
    return json.dumps(topics)


def kafka_options(
    servers: str,
    topic: str,
    positions: Mapping[tuple[str, int], int] | None = None,
    max_offsets: int | None = None,
    min_partitions: int | None = None,
    group_prefix: str | None = None,
) -> dict[str, str]:
    """Options for one topic: from stored positions if there are any, else from the newest record.

    They apply to the first start only; afterwards the checkpoint decides.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets(positions) if positions else "latest",
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    if group_prefix:
        options["groupIdPrefix"] = group_prefix
    return options


def kafka_topic(spark: SparkSession, servers: str, topic: str, **kwargs) -> DataFrame:
    """A topic as a stream of (key, value, topic, partition, offset, timestamp); needs the Kafka connector."""
    stream = spark.readStream.format("kafka").options(**kafka_options(servers, topic, **kwargs)).load()
    return stream.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in TOPIC_RECORD],
    )


def topic_folder(root: str, topic: str) -> str:
    """Where a topic lies below a root: in a folder of its name, landed by hand or by the topic sinks."""
    return f"{root}/{{_topic=,}}{topic}"


def file_topic(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same stream from landed files."""
    # Batch folders below are no columns: with partition discovery, a query started before the first one would not know them.
    reader = spark.readStream.schema(TOPIC_RECORD).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).select(*TOPIC_RECORD.names)


def land(messages: DataFrame, topic: str, path: str, mode: str = "append", pieces: int | None = None) -> None:
    """Write (key, value, offset, timestamp) rows as a landed topic, in ``pieces`` of equal size, as a topic has partitions."""
    records = messages.select(
        F.col("key").cast("string").alias("key"),
        "value",
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
    )
    dealt = records.repartition(pieces, *records.columns) if pieces else records
    dealt.write.mode(mode).option("compression", "zstd").option("parquet.block.size", str(ROW_GROUP)).parquet(path)
