"""Dates and hours as the records carry them: zero-padded text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def day_hour_minute(millis: Column) -> list[Column]:
    at = F.timestamp_millis(millis)
    return [F.date_format(at, "yyyy-MM-dd").alias("dt"),
            F.date_format(at, "HH").alias("hr"),
            F.date_format(at, "mm").alias("mi")]


def create_parts(text: Column) -> tuple[Column, Column]:
    """Day and hour of ``yyyy-MM-dd HH:mm:ss`` text; NULL where the text is too short."""
    halves = F.split(text, " ")
    return F.get(halves, F.lit(0)), F.get(F.split(F.get(halves, F.lit(1)), ":"), F.lit(0))


def compact_day(day: Column) -> Column:
    return F.replace(day, F.lit("-"), F.lit(""))


def day_before(day: Column) -> Column:
    """The day before ``yyyy-MM-dd``; text that is no date raises under ANSI mode."""
    return F.date_format(F.date_add(F.to_date(day, "yyyy-MM-dd"), -1), "yyyy-MM-dd")
