"""Fanning the database change log out to one topic per table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillstream.functions import codec
from tillstream.operators.ingest import QUARANTINE

# Fixed values of the change-log contract.
FACT_TABLES = ("order_info", "order_detail")
DIM_TABLES = ("base_province", "user_info", "sku_info", "base_trademark", "base_category3",
              "spu_info")
ARRAY_INSERT = "INSERT"
OBJECT_INSERT = "insert"
DELETE = "delete"
EMPTY_DATA_LENGTH = 3

_NOTHING = "array<struct<topic:string,value:string>>"


def _topic() -> Column:
    return F.concat(F.lit("ODS_"), F.upper("table"))


def _fan(parsed: DataFrame, accepted: Column, messages: Column) -> DataFrame:
    """Explode accepted envelopes; malformed ones become a quarantine message, in one pass."""
    bad = F.col("malformed") | F.col("table").isNull()
    out = (F.when(bad, F.array(F.struct(F.lit(QUARANTINE).alias("topic"), F.col("value"))))
            .when(accepted, messages)
            .otherwise(F.array().cast(_NOTHING)))
    return (parsed.select(F.explode(out).alias("m"))
                  .select("m.topic", _key(F.col("m.topic"), F.col("m.value")).alias("key"),
                          "m.value"))


def _key(topic: Column, value: Column) -> Column:
    """Dimension rows travel under their id, so that changes of one row keep their order."""
    return F.when(topic.isin(*[f"ODS_{t.upper()}" for t in DIM_TABLES]),
                  F.get_json_object(value, "$.id"))


def fanout_array(messages: DataFrame) -> DataFrame:
    """Envelopes ``{table, type, data:[row, ...]}``: inserted order rows, one message each."""
    parsed = codec.parse_envelope(messages, "table string, type string, data array<string>")
    accepted = (F.col("table").isin(*FACT_TABLES) & (F.col("type") == ARRAY_INSERT)
                & F.col("data").isNotNull())
    topic = _topic()
    rows = F.transform("data", lambda row: F.struct(topic.alias("topic"), row.alias("value")))
    return _fan(parsed, accepted, rows)


def fanout_object(messages: DataFrame, changes: bool = False) -> DataFrame:
    """Envelopes ``{table, type, data:{row}}``: inserted order rows, and dimension rows of any
    change type. Bootstrap markers carry an empty object and are dropped by its length. With
    ``changes``, dimension rows say whether they delete and when (``ts``) they were changed, in members
    ``_op`` and ``_at`` (see ``dims.dim_changes``)."""
    parsed = codec.parse_envelope(messages, "table string, type string, data string, ts string")
    table = F.col("table")
    accepted = (F.length("data") > EMPTY_DATA_LENGTH) & (
        (table.isin(*FACT_TABLES) & (F.col("type") == OBJECT_INSERT))
        | table.isin(*DIM_TABLES))
    value = F.col("data")
    if changes:
        marks = F.concat(F.lit('{"_op":"'), F.when(F.col("type") == DELETE, DELETE).otherwise("upsert"),
                         F.lit('","_at":'), F.coalesce(F.col("ts").try_cast("bigint"), F.lit(0)), F.lit(","))
        value = F.when(table.isin(*DIM_TABLES), F.concat(marks, F.substring(F.trim("data"), F.lit(2),
                                                                            F.length("data")))).otherwise(value)
    row = F.array(F.struct(_topic().alias("topic"), value.alias("value")))
    return _fan(parsed, accepted, row)
