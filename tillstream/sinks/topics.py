"""Message writers: one sink serves every topic through the ``topic`` column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from tillstream.functions import codec
from tillstream.sources.streams import TopicSpec
from tillstream.streaming import delivery


def messages(rows: DataFrame, topic: str, key: Column | None = None) -> DataFrame:
    """Rows as (topic, key, value) messages; a key keeps the messages of one id together."""
    none = F.lit(None).cast("string")
    return rows.select(F.lit(topic).alias("topic"),
                       (none if key is None else key.cast("string")).alias("key"),
                       codec.encode(rows).alias("value"))


def write_topics(batch: DataFrame, spec: TopicSpec, batch_id: int, writer: str = "default") -> None:
    """Publish a batch of messages from ``foreachBatch``. Kafka gets them at least once; message
    files carry the writer and batch in their folder name, and a replay replaces them. With
    ``spec.once`` every message takes its identity along (``streaming.delivery``)."""
    if spec.once:
        delivery.send_identified(batch, writer, batch_id, lambda rows: _send(rows, spec, batch_id, writer))
    else:
        _send(batch.select("topic", "key", "value"), spec, batch_id, writer)


def _send(rows: DataFrame, spec: TopicSpec, batch_id: int, writer: str) -> None:
    if spec.kind == "kafka":
        if spec.once:
            rows = rows.select("topic", "key", "value", delivery.headers().alias("headers"))
        (rows.write.format("kafka")
         .option("kafka.bootstrap.servers", spec.address).options(**spec.options).save())
        return
    # One partition level below the topic folder, so that a replay overwrites its own files.
    tagged = rows.withColumn("part", F.lit(f"{writer}-{batch_id}"))
    (tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("topic", "part").parquet(spec.address))


def archive_raw(lines: DataFrame, path: str) -> DataStreamWriter:
    """Keep every raw line, by the day it was received, as text files."""
    day = F.date_format(F.current_timestamp(), "yyyy-MM-dd")
    return (lines.select("value", day.alias("dt")).writeStream
            .format("text").partitionBy("dt").option("path", path))
