"""Rows the keyed dimension and state tables receive."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tillstream.functions import codec

# A topic keeps the messages of one id in one partition, where offsets tell their order; what
# reached several partitions is ordered by time first.
ARRIVAL = ["_timestamp", "_offset"]


def dim_rows(messages: DataFrame, schema: T.StructType, key: str = "id") -> DataFrame:
    """Typed rows of a dimension topic with their arrival position; a row without its key
    cannot be stored. Rows of any change type arrive here, deletes among them, and all are
    stored as the latest known value."""
    rows = codec.parse_typed(messages, schema, keep=("timestamp", "offset"))
    renamed = rows.withColumnsRenamed({"timestamp": ARRIVAL[0], "offset": ARRIVAL[1]})
    return renamed.where(F.col(key).isNotNull())


# What a table that knows deletes holds beside the row: when it was changed, by the change log and then
# by arrival, and whether it is gone.
CHANGED = ["changed_at", "changed_no"]
_MARKS = T.StructType([T.StructField(CHANGED[0], T.LongType()), T.StructField(CHANGED[1], T.LongType()),
                       T.StructField("deleted", T.BooleanType())])


def changes_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, *_MARKS.fields])


def dim_changes(messages: DataFrame, schema: T.StructType, key: str = "id") -> DataFrame:
    """Rows of a dimension topic fanned out with ``changes``. A delete is a row like others, a
    tombstone, so that an older change of the same id that arrives later does not bring it back."""
    sent = T.StructType([*schema.fields, T.StructField("_op", T.StringType()), T.StructField("_at", T.LongType())])
    rows = codec.parse_typed(messages, sent, keep=("timestamp", "offset"))
    # Arrival in milliseconds and place in the batch of messages, for changes of the same second.
    arrived = F.unix_millis("timestamp") * F.lit(1 << 20) + F.col("offset") % (1 << 20)
    return rows.where(F.col(key).isNotNull()).select(
        *schema.names, F.coalesce("_at", F.lit(0)).alias(CHANGED[0]), arrived.alias(CHANGED[1]),
        F.coalesce(F.col("_op") == "delete", F.lit(False)).alias("deleted"))


def user_state_rows(orders: DataFrame) -> DataFrame:
    """One "has ordered" row per user seen in ``orders``."""
    users = orders.select(F.col("user_id").cast("string").alias("user_id"))
    return users.where(F.col("user_id").isNotNull()).distinct().withColumn("if_consumed", F.lit("1"))
