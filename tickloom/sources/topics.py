"""Topic and file sources of messages, and publishing.

The topic connector is not part of a plain Spark install; files with the same three columns
(``value``, ``partition``, ``offset``) stand in for a topic in local runs.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom.schema import MESSAGE
from tickloom.sources.codec import decode_avro, encode_avro

TOPIC = "stock_data"


@dataclass(frozen=True)
class TopicSource:
    """A broker topic with Avro messages. ``options`` go to the connector, such as
    ``maxOffsetsPerTrigger`` or ``minPartitions`` (splits hot partitions over more tasks)."""

    servers: str
    topic: str = TOPIC
    options: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class FileSource:
    """A folder of message files."""

    path: str
    format: str = "parquet"
    schema: T.StructType = MESSAGE
    options: dict[str, str] = field(default_factory=dict)


def _positioned(df: DataFrame) -> DataFrame:
    return decode_avro(df.select("value", "partition", "offset"))


def read_ticks_stream(spark: SparkSession, source: TopicSource | FileSource) -> DataFrame:
    """Unbounded messages ``(value, partition, offset)``."""
    if isinstance(source, FileSource):
        reader = spark.readStream.format(source.format).schema(source.schema)
        return reader.options(**source.options).load(source.path)
    reader = spark.readStream.format("kafka").option("subscribe", source.topic)
    stream = reader.option("kafka.bootstrap.servers", source.servers).options(**source.options)
    return _positioned(stream.load())


def read_messages(spark: SparkSession, source: TopicSource | FileSource) -> DataFrame:
    """The same messages as a bounded table."""
    if isinstance(source, FileSource):
        return spark.read.format(source.format).schema(source.schema).options(**source.options).load(source.path)
    reader = spark.read.format("kafka").option("subscribe", source.topic)
    return _positioned(
        reader.option("kafka.bootstrap.servers", source.servers).options(**source.options).load())


def one_message_options(topic: str, partition: int, offset: int) -> dict[str, str]:
    """Connector options that read exactly one message of one partition."""
    return {
        "assign": json.dumps({topic: [partition]}),
        "startingOffsets": json.dumps({topic: {str(partition): offset}}),
        "endingOffsets": json.dumps({topic: {str(partition): offset + 1}}),
    }


def read_message(spark: SparkSession, source: TopicSource | FileSource, partition: int,
                 offset: int) -> DataFrame:
    """One message by position. On files the filter reaches the scan."""
    if isinstance(source, FileSource):
        return read_messages(spark, source).filter(
            (F.col("partition") == partition) & (F.col("offset") == offset))
    options = one_message_options(source.topic, partition, offset)
    reader = spark.read.format("kafka").option("kafka.bootstrap.servers", source.servers)
    return _positioned(reader.options(**options).load())


def write_ticks_topic(df: DataFrame, servers: str, checkpoint: str | None = None,
                      topic: str = TOPIC) -> StreamingQuery | None:
    """Publish messages as Avro; a stream starts a query, a table is written once."""
    encoded = encode_avro(df).select("value")
    options = {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all"}
    if df.isStreaming:
        writer = encoded.writeStream.format("kafka").options(**options)
        return writer.option("checkpointLocation", checkpoint).start()
    encoded.write.format("kafka").options(**options).save()
    return None
