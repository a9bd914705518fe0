"""Answers over the stored tables: daily and hourly totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillstream.functions import clock

# Fixed values of the dashboard's answers; the new-device figure is a placeholder.
DAU_ID, DAU_NAME = "dau", "新增日活"
NEW_MID_ID, NEW_MID_NAME, NEW_MID_VALUE = "new_mid", "新增设备", "233"
HOUR_BUCKETS = 24


def dau_total(dau: DataFrame, date: str) -> DataFrame:
    return dau.where(F.col("dt") == date).agg(F.count(F.lit(1)).alias("total"))


def dau_total_by_day(dau: DataFrame) -> DataFrame:
    return dau.groupBy("dt").agg(F.count(F.lit(1)).alias("total"))


def dau_hours(dau: DataFrame) -> DataFrame:
    """First visits by day and hour; an hour without any has no row."""
    return dau.groupBy("dt", "hr").agg(F.count(F.lit(1)).alias("visits"))


def dau_by_hour(dau: DataFrame, date: str) -> DataFrame:
    """The busiest hours of a day first, at most one bucket per hour of the clock."""
    hours = dau_hours(dau.where(F.col("dt") == date)).select("hr", "visits")
    return hours.orderBy(F.desc("visits"), "hr").limit(HOUR_BUCKETS)


def realtime_total(dau: DataFrame, date: str) -> DataFrame:
    """Metric rows (id, name, value)."""
    active = dau_total(dau, date).select(
        F.lit(DAU_ID).alias("id"), F.lit(DAU_NAME).alias("name"),
        F.col("total").cast("string").alias("value"))
    fixed = dau.sparkSession.range(1).select(
        F.lit(NEW_MID_ID).alias("id"), F.lit(NEW_MID_NAME).alias("name"),
        F.lit(NEW_MID_VALUE).alias("value"))
    return active.unionByName(fixed)


def realtime_hour(dau: DataFrame, date: str, metric: str = DAU_ID) -> DataFrame:
    """(day, hr, visits) for a date and the day before it; empty for an unknown metric."""
    today, before = F.lit(date), clock.day_before(F.lit(date))
    both = dau.where((F.col("dt") == today) | (F.col("dt") == before))
    if metric != DAU_ID:
        both = both.where(F.lit(False))
    label = F.when(F.col("dt") == today, "today").otherwise("yesterday")
    return dau_hours(both).select(label.alias("day"), "hr", "visits")


def realtime_total_json(dau: DataFrame, date: str) -> DataFrame:
    """The metric rows as one JSON array; there are two of them."""
    metric = F.struct("id", "name", "value")
    return realtime_total(dau, date).agg(
        F.to_json(F.sort_array(F.collect_list(metric))).alias("json"))


def realtime_hour_json(dau: DataFrame, date: str, metric: str = DAU_ID) -> DataFrame:
    """``{"yesterday":{hr:n},"today":{hr:n}}``, built from at most 48 hour buckets."""
    def hours_of(day: str):
        entry = F.when(F.col("day") == day, F.struct("hr", "visits"))
        return F.map_from_entries(F.sort_array(F.collect_list(entry))).alias(day)
    answer = realtime_hour(dau, date, metric).agg(hours_of("yesterday"), hours_of("today"))
    text = F.to_json(F.struct("yesterday", "today"))
    return answer.select(F.when(F.lit(metric == DAU_ID), text).alias("json"))


def _day(wide: DataFrame, date: str | None) -> DataFrame:
    return wide if date is None else wide.where(F.col("dt") == date)


def order_amount_total(wide: DataFrame, date: str, measure: str = "final_total_amount") -> DataFrame:
    """Sum of the paid amount over the wide rows of a day; NULL when it has none.

    The default measure is order-level and counts once per detail, as the dashboard defines
    it; ``final_detail_amount`` counts every paid cent once.
    """
    return _day(wide, date).agg(F.sum(measure).alias("sum_amount"))


def order_amount_by_day(wide: DataFrame) -> DataFrame:
    return wide.groupBy("dt").agg(F.sum("final_total_amount").alias("sum_amount"),
                                  F.sum("final_detail_amount").alias("sum_detail_amount"))


def order_amount_by_hour(wide: DataFrame, date: str | None = None) -> DataFrame:
    """Sum of the paid amount by hour of ``create_time``, for a day or for every day."""
    hour = F.hour(F.to_timestamp("create_time", "yyyy-MM-dd HH:mm:ss"))
    keys = [hour.cast("bigint").alias("hrm")] if date else ["dt", hour.cast("bigint").alias("hrm")]
    return _day(wide, date).groupBy(*keys).agg(F.sum("final_total_amount").alias("am"))
