"""Answers that are kept up to date instead of being counted again.

A micro-batch adds what is new and takes back what no longer holds: one device less in the hour that its
first visit has left, the old amounts of a row that has been settled anew. Every batch stores the sums of
its signed changes, in folders by day or month, and writes only those that changed; an answer is the sum
of these partial sums, and an answer about one day opens its folder alone. A batch reads what earlier
batches wrote, so a replay finds and writes what the first attempt did, and the sums do not depend on how
the input was cut or ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tillstream import schemas
from tillstream.functions import codec
from tillstream.operators import dau
from tillstream.operators.keyed import earliest_per_key, latest_per_key, same_key
from tillstream.sinks import tables as sink_tables
from tillstream.streaming.pairs import PairStore

HOURS = T.StructType([T.StructField("dt", T.StringType()), T.StructField("hr", T.StringType()),
                      T.StructField("visits", T.LongType())])
AMOUNTS = T.StructType([T.StructField("month", T.StringType()), T.StructField("dt", T.StringType()),
                        T.StructField("hrm", T.LongType()),
                        T.StructField("rows", T.LongType()),
                        T.StructField("sum_amount", T.DecimalType(28, 2)),
                        T.StructField("sum_detail_amount", T.DecimalType(28, 2))])


# ---- first visits by day and hour ---------------------------------------------------------------

def keep_hours(batch: DataFrame, n: int, root: str) -> None:
    """Count a micro-batch of start logs into the kept hours: a device not seen on its day comes in, one
    whose first visit turns out to be earlier moves to that hour."""
    spark, visits = batch.sparkSession, f"{root}/visits"
    fresh = dau.first_visit(batch).select("dt", "mid", "hr", "ts")
    # As many values as the batch has days.
    days = [r[0] for r in batch.select("dt").distinct().collect() if r[0] is not None]
    before = sink_tables.read_slots(spark, visits, T.StructType([
        schemas.DAU_INFO[c] for c in ("dt", "mid", "hr", "ts")]), days, n, slot="dt")
    asked = fresh.select(F.col("dt").alias("_dt"), F.col("mid").alias("_mid"))
    known = before.join(asked, same_key(F.col("mid"), F.col("_mid")) & (F.col("dt") == F.col("_dt")), "left_semi")
    known = (earliest_per_key(known.drop("batch"), ["dt", "mid"], ["ts"])
             .select(F.col("dt").alias("_dt"), F.col("mid").alias("_mid"), F.col("hr").alias("_hr"),
                     F.col("ts").alias("_ts")))
    met = fresh.join(known, same_key(F.col("mid"), F.col("_mid")) & (F.col("dt") == F.col("_dt")), "left")
    moved = met.where(F.col("_ts").isNull() | (F.col("ts") < F.col("_ts")))
    sink_tables.append_slots(moved.select("dt", "mid", "hr", "ts", F.col("_hr").alias("left")), visits, n, "dt")
    # The changes are read from what is stored, so that they are those of the visits kept.
    stored = sink_tables.read_slots(
        spark, visits, T.StructType([*HOURS.fields[:2], T.StructField("left", T.StringType())]),
        days, only_batch=n, slot="dt")
    change = F.explode(F.array(F.struct(F.col("hr").alias("hr"), F.lit(1).alias("visits")),
                               F.struct(F.col("left").alias("hr"), F.lit(-1).alias("visits"))))
    sums = (stored.select("dt", change.alias("c")).where("c.hr IS NOT NULL")
            .groupBy("dt", F.col("c.hr").alias("hr")).agg(F.sum("c.visits").alias("visits")).where("visits <> 0"))
    sink_tables.append_slots(sums, f"{root}/hours", n, "dt")


def hours(spark: SparkSession, root: str, days: Sequence[str] | None = None) -> DataFrame:
    """First visits by day and hour, of all days or of some."""
    parts = sink_tables.read_slots(spark, f"{root}/hours", HOURS, days, slot="dt")
    return parts.groupBy("dt", "hr").agg(F.sum("visits").alias("visits")).where("visits > 0")


# ---- amounts by day and hour --------------------------------------------------------------------

def _signed(rows: DataFrame, sign: int) -> DataFrame:
    at = F.try_to_timestamp("create_time", F.lit(codec.TIME_FORMAT))
    money: list[Column] = [F.coalesce(F.col(c), F.lit(0)) * sign for c in
                           ("final_total_amount", "final_detail_amount")]
    return rows.select(F.substring("dt", 1, 7).alias("month"), "dt", F.hour(at).cast("long").alias("hrm"),
                       F.lit(sign).cast("long").alias("rows"), money[0].alias("sum_amount"),
                       money[1].alias("sum_detail_amount"))


def keep_amounts(store: PairStore, settled: DataFrame, n: int, root: str) -> None:
    """Count the rows that ``pairs.settle`` stored in batch ``n`` into the kept amounts, and take back
    what these pairs counted for before."""
    pair = ["order_id", "order_detail_id"]
    slots = [r[0] for r in settled.select(store.slot_of(F.col("order_id"))).distinct().collect()]
    earlier = sink_tables.read_slots(store.spark, store.table("wide"), schemas.ORDER_WIDE, slots, n)
    again = settled.select(*[F.col(c).alias(f"_{c}") for c in pair])
    on = same_key(F.col(pair[1]), F.col(f"_{pair[1]}")) & (F.col(pair[0]) == F.col(f"_{pair[0]}"))
    was = latest_per_key(earlier.join(again, on, "left_semi"), pair, ["batch"])
    changes = _signed(settled, 1).unionByName(_signed(was, -1))
    amounts = [F.sum(c).cast("decimal(28,2)").alias(c) for c in ("sum_amount", "sum_detail_amount")]
    sums = changes.groupBy("month", "dt", "hrm").agg(F.sum("rows").alias("rows"), *amounts)
    sink_tables.append_slots(sums.where("rows <> 0 OR sum_amount <> 0 OR sum_detail_amount <> 0"),
                             f"{root}/amounts", n, "month")


def amounts(spark: SparkSession, root: str, date: str | None = None) -> DataFrame:
    """Paid amount, per order row and split to the details, by day and hour, for a day or for all."""
    parts = sink_tables.read_slots(spark, f"{root}/amounts", AMOUNTS, None if date is None else [date[:7]],
                                   slot="month")
    parts = parts if date is None else parts.where(F.col("dt") == date)
    sums = [F.sum(c).alias(c) for c in ("rows", "sum_amount", "sum_detail_amount")]
    return parts.groupBy("dt", "hrm").agg(*sums).where("rows > 0").drop("rows")
