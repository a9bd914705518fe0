"""Routing raw app-log lines to the start and event topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillstream.functions import codec

START, EVENT, QUARANTINE = "START_LOG", "EVENT_LOG", "QUARANTINE"


def route_app_log(lines: DataFrame, start: str = START, event: str = EVENT,
                  quarantine: str = QUARANTINE) -> DataFrame:
    """(topic, key, value): a line with a non-empty ``start`` is a start log, any other an
    event log; malformed text is set aside instead of failing the job."""
    parsed = codec.parse_envelope(lines, "start string")
    topic = (F.when(F.col("malformed"), quarantine)
              .when(F.length("start") > 0, start)
              .otherwise(event))
    return parsed.select(topic.alias("topic"), F.lit(None).cast("string").alias("key"), "value")


def parse_lines(lines: DataFrame) -> DataFrame:
    """Log lines with their parsed form ``log`` (VARIANT), in which any member can be found by path
    without another parse; NULL where the line is no JSON."""
    return lines.withColumn("log", F.try_parse_json("value"))


def route_parsed(parsed: DataFrame, start: str = START, event: str = EVENT,
                 quarantine: str = QUARANTINE) -> DataFrame:
    """``route_app_log`` over parsed lines, which are carried along: (topic, key, value, log)."""
    whole = F.coalesce(F.schema_of_variant("log").startswith("OBJECT"), F.lit(False))
    topic = (F.when(~whole, quarantine)
              .when(F.length(F.try_variant_get("log", "$.start", "string")) > 0, start)
              .otherwise(event))
    return parsed.select(topic.alias("topic"), F.lit(None).cast("string").alias("key"), "value", "log")


def schema_drift(routed: DataFrame) -> DataFrame:
    """Per topic the number of lines and the merged schema of what they hold: a member that appears,
    goes or changes its type shows here first. One aggregate, combined before the shuffle."""
    return routed.groupBy("topic").agg(F.count(F.lit(1)).alias("lines"),
                                       F.schema_of_variant_agg("log").alias("shape"))
