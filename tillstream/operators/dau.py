"""Daily active devices: first start log per day and device."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from tillstream import schemas
from tillstream.functions import clock, codec
from tillstream.operators.keyed import earliest_per_key

_SHAPE = ("common struct<mid: string, uid: string, ar: string, ch: string, vc: string>, "
          "ts string")


def parse_start_log(messages: DataFrame) -> DataFrame:
    """Flatten start-log messages; ``malformed`` marks text without a device or a time."""
    parsed = codec.parse_envelope(messages.select("value"), _SHAPE)
    ts = F.col("ts").try_cast("bigint")
    lost = F.col("malformed") | F.col("common.mid").isNull() | ts.isNull()
    flat = parsed.select("value", "common.*", ts.alias("ts"), lost.alias("malformed"))
    return flat.select("value", "malformed", "mid", "uid", "ar", "ch", "vc",
                       *clock.day_hour_minute(F.col("ts")), "ts")


def to_dau_info(messages: DataFrame) -> DataFrame:
    return parse_start_log(messages).where(~F.col("malformed")).select(*schemas.DAU_INFO.names)


def rejected(messages: DataFrame) -> DataFrame:
    """The raw lines ``to_dau_info`` leaves out."""
    return parse_start_log(messages).where("malformed").select("value")


def first_visit(starts: DataFrame, before: Observation | None = None,
                after: Observation | None = None) -> DataFrame:
    """First start log per (day, device), with optional row counts on either side."""
    if before is not None:
        starts = starts.observe(before, F.count(F.lit(1)).alias("rows"))
    kept = earliest_per_key(starts, ["dt", "mid"], ["ts"])
    if after is not None:
        kept = kept.observe(after, F.count(F.lit(1)).alias("rows"))
    return kept


def dedup_metrics(starts: DataFrame) -> DataFrame:
    """Rows before and after the first-visit filter, by day."""
    visits = starts.groupBy("dt", "mid").agg(F.count(F.lit(1)).alias("n"))
    return visits.groupBy("dt").agg(F.sum("n").alias("rows_before"),
                                    F.count(F.lit(1)).alias("rows_after"))
