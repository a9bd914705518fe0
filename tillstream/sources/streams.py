"""Stream readers. A topic is a Kafka topic or a folder of message files, by ``TopicSpec``."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamReader

from tillstream.streaming import delivery

MESSAGE_FILE = f"key string, value string, {delivery.IDENTITY} string"
_MESSAGE = ["key", "value", "topic", "partition", "offset", "timestamp"]


@dataclass(frozen=True)
class TopicSpec:
    """Where topics live: ``kafka`` with bootstrap servers, or ``files`` below a root folder. With
    ``once``, messages carry identities and readers drop what they have read in the last ``remember``."""
    kind: str
    address: str
    options: dict[str, str] = field(default_factory=dict)
    once: bool = False
    remember: str = "1 day"


def kafka_options(spec: TopicSpec, topic: str, group: str | None = None,
                  starting_offsets: dict[int, int] | str = "latest") -> dict[str, str]:
    """Reader options. ``starting_offsets`` maps partition to offset and counts only for the
    first run of a query; afterwards its checkpoint holds the position."""
    start = (starting_offsets if isinstance(starting_offsets, str)
             else json.dumps({topic: {str(p): o for p, o in starting_offsets.items()}}))
    options = {"kafka.bootstrap.servers": spec.address, "subscribe": topic,
               "startingOffsets": start, **spec.options}
    if group is not None:
        options["kafka.group.id"] = group
    return options


def topic_folder(spec: TopicSpec, topic: str) -> str:
    return f"{spec.address}/topic={topic}"


def topic_stream(spark: SparkSession, spec: TopicSpec, topic: str, group: str | None = None,
                 starting_offsets: dict[int, int] | str = "latest") -> DataFrame:
    """Messages of a topic: key, value, topic, partition, offset, timestamp."""
    if spec.kind == "kafka":
        return _from_kafka(spark.readStream, kafka_options(spec, topic, group, starting_offsets), spec)
    return _from_files(spark.readStream.schema(MESSAGE_FILE).options(**spec.options)
                       .parquet(topic_folder(spec, topic)), topic, spec)


def topic_rows(spark: SparkSession, spec: TopicSpec, topic: str) -> DataFrame:
    """All messages a topic holds now, as a batch; columns as those of ``topic_stream``."""
    if spec.kind == "kafka":
        return _from_kafka(spark.read, kafka_options(spec, topic, None, "earliest"), spec)
    return _from_files(spark.read.schema(MESSAGE_FILE).parquet(topic_folder(spec, topic)), topic, spec)


def _from_kafka(reader: DataFrameReader | DataStreamReader, options: dict[str, str],
                spec: TopicSpec) -> DataFrame:
    raw = reader.format("kafka").options(**options)
    if not spec.once:
        return _as_text(raw.load())
    raw = raw.option("includeHeaders", "true").load()
    return delivery.once(_as_text(raw, delivery.from_headers().alias(delivery.IDENTITY)), spec.remember)


def _as_text(raw: DataFrame, *more: Column) -> DataFrame:
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"), *_MESSAGE[2:], *more)


def _from_files(raw: DataFrame, topic: str, spec: TopicSpec) -> DataFrame:
    # A folder has no broker offsets: arrival order is that of the files, then of their rows.
    place = F.concat_ws(":", F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    rows = raw.select("key", "value", F.lit(topic).alias("topic"),
                      F.lit(0).alias("partition"), F.col("_metadata.row_index").alias("offset"),
                      F.col("_metadata.file_modification_time").alias("timestamp"),
                      F.coalesce(delivery.IDENTITY, place).alias(delivery.IDENTITY))
    return delivery.once(rows, spec.remember) if spec.once else rows.select(*_MESSAGE)


def raw_log_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Raw app-log lines of a folder of text files, one message per line."""
    return spark.readStream.options(**options).text(path)
