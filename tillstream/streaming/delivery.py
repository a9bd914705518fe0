"""Messages that count once, although a replayed batch is sent again.

A writer that dies between sending a batch and committing it sends the batch again, and a topic keeps
both. So each message carries an identity: writer, batch, digest of what it says, and its number among
the batch's messages that say the same. A replay makes the same identities, in whatever order and
partitions it computes the batch, and a reader drops those it has seen.

A reader forgets an identity some time after it has read it; the time is that of reading, so no message
is ever late, and a message sent again after that time is read again. Messages without an identity, of
other writers, have that of their place in the topic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillstream.session import run_dir
from tillstream.streaming.runtime import discard

IDENTITY = "identity"


def identified(batch: DataFrame, writer: str, batch_id: int, folder: str) -> DataFrame:
    """Messages (topic, key, value) with their ``identity``. They are stored in ``folder`` first, so
    that one attempt numbers what it sends.

    Null keys and values differ from empty ones. Messages that say the same are counted before they are
    shuffled and stand where the last of them stood; a batch without such messages is not shuffled."""
    said = F.sha2(F.to_json(F.struct("topic", "key", "value")), 256)
    (batch.select("topic", "key", "value", said.alias("said"),
                  F.monotonically_increasing_id().alias("place")).write.parquet(folder))
    rows = batch.sparkSession.read.schema(
        "topic string, key string, value string, said string, place long").parquet(folder)
    again = (rows.groupBy("topic", "key", "value", "said")
             .agg(F.count(F.lit(1)).alias("n"), F.max("place").alias("place")).where("n > 1"))
    if again.limit(1).count():
        copies = again.select("topic", "key", "value", "said", "place",
                              F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy"))
        once = rows.join(again.select("said"), "said", "left_anti").withColumn("copy", F.lit(0).cast("long"))
        rows = once.unionByName(copies).orderBy("place")
    else:
        rows = rows.withColumn("copy", F.lit(0).cast("long"))
    return rows.select("topic", "key", "value", F.concat_ws(
        "/", F.lit(writer), F.lit(batch_id), "said", "copy").alias(IDENTITY))


def send_identified(batch: DataFrame, writer: str, batch_id: int, send) -> None:
    """Hand the identified messages to ``send``."""
    spark = batch.sparkSession
    folder = run_dir(spark, "identified")
    send(identified(batch, writer, batch_id, folder))
    discard(spark, folder)


def headers() -> Column:
    """The identity as Kafka takes it along."""
    return F.array(F.struct(F.lit(IDENTITY).alias("key"), F.col(IDENTITY).cast("binary").alias("value")))


def from_headers() -> Column:
    """The identity among a Kafka message's headers, else its place in the topic."""
    own = F.filter("headers", lambda h: h["key"] == IDENTITY)
    return F.coalesce(F.get(own, F.lit(0))["value"].cast("string"),
                      F.concat_ws(":", "topic", "partition", "offset"))


def once(messages: DataFrame, remember: str = "1 day") -> DataFrame:
    """Messages whose ``identity`` has not been read for ``remember``; of a batch DataFrame, one of each
    identity. Other columns stay as they are."""
    if not messages.isStreaming:
        return messages.dropDuplicates([IDENTITY]).drop(IDENTITY)
    read_at = messages.withColumn("read_at", F.current_timestamp()).withWatermark("read_at", remember)
    return read_at.dropDuplicatesWithinWatermark([IDENTITY]).drop(IDENTITY, "read_at")
