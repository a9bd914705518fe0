"""Wide order rows: joining orders with their details and splitting the paid amount.

An order id is unique among orders and may repeat without bound among details. Every join
here is an equi-join on it, so AQE can split the details of a hot order over many tasks; no
window or collected list gathers an order's details.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillstream import schemas
from tillstream.functions import money
from tillstream.operators.keyed import same_key

# Hopping window length and slide, wait of the cached join, in seconds.
HOP_WINDOW, HOP_SLIDE, CACHE_WAIT = 15, 5, 600

# How long an order's running sums are remembered after its last detail, in seconds (fixed).
SUMS_TTL = 1000
DETAIL_AT = "detail_at"
RUNNING_SUMS = T.StructType([T.StructField(name, T.LongType())
                             for name in ("order_id", "part", "share", "last_at")])

_FROM_ORDER = {
    "order_id": "id", "order_status": "order_status", "create_time": "create_time",
    "user_id": "user_id", "benefit_reduce_amount": "benefit_reduce_amount",
    "original_total_amount": "original_total_amount", "feight_fee": "feight_fee",
    "final_total_amount": "final_total_amount", "if_first_order": "if_first_order",
    "province_name": "province_name", "province_area_code": "province_area_code",
    "user_age_group": "user_age_group", "user_gender": "user_gender", "dt": "create_date",
}
_FROM_DETAIL = {
    "order_detail_id": "id", "sku_id": "sku_id", "sku_price": "order_price",
    "sku_num": "sku_num", "sku_name": "sku_name", "spu_id": "spu_id", "tm_id": "tm_id",
    "category3_id": "category3_id", "spu_name": "spu_name", "tm_name": "tm_name",
    "category3_name": "category3_name",
}


def _pair(orders: DataFrame, details: DataFrame, how: str = "inner",
          also: Column | None = None) -> DataFrame:
    on = same_key(F.col("o.id"), F.col("d.order_id"))
    return orders.alias("o").join(details.alias("d"), on if also is None else on & also, how)


def _seconds(at: str) -> Column:
    return F.unix_seconds(F.col(at).cast("timestamp"))


def batch_join(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Every order-detail pair, columns under the aliases ``o`` and ``d``."""
    return _pair(orders, details)


def same_hop_window(left: Column, right: Column, window: int = HOP_WINDOW,
                    slide: int = HOP_SLIDE) -> Column:
    """Do two times (in seconds) share a hopping window? They do when their slide buckets lie
    less than window / slide apart; no row is copied into its several windows for that."""
    reach = window // slide - 1
    return F.abs(F.floor(left / slide) - F.floor(right / slide)) <= reach


def hop_join(orders: DataFrame, details: DataFrame, window: int = HOP_WINDOW,
             slide: int = HOP_SLIDE) -> DataFrame:
    """Pairs meeting in a window of ``window`` seconds that slides by ``slide``; each once.
    Both sides need a timestamp column ``event_time``."""
    return _pair(orders, details, also=same_hop_window(
        _seconds("o.event_time"), _seconds("d.event_time"), window, slide))


def _within(wait: int) -> Column:
    span = F.expr(f"interval {int(wait)} seconds")
    order_at, detail_at = F.col("o.event_time"), F.col("d.event_time")
    return (detail_at >= order_at - span) & (detail_at <= order_at + span)


def interval_join(orders: DataFrame, details: DataFrame, wait: int = CACHE_WAIT) -> DataFrame:
    """Pairs at most ``wait`` seconds apart, whichever side came first."""
    return _pair(orders, details, also=_within(wait))


def interval_details(orders: DataFrame, details: DataFrame, wait: int, also: Column) -> DataFrame:
    """``interval_join`` under a further condition, and the details that meet no order."""
    on = same_key(F.col("o.id"), F.col("d.order_id")) & _within(wait) & also
    return details.alias("d").join(orders.alias("o"), on, "left")


def full_outer_pairs(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Pairs, lonely orders and lonely details: wide rows with a ``side`` column.

    A full outer join cannot be split on a hot key, so it is put together from a left join,
    which can, and the orders missing from the details' distinct order ids.
    """
    matched = F.when(F.col("o.id").isNotNull(), "both").otherwise("detail")
    left = details.alias("d").join(orders.alias("o"),
                                   same_key(F.col("d.order_id"), F.col("o.id")), "left")
    known = details.select(F.col("order_id").alias("_known")).distinct()
    lonely = orders.join(known, orders["id"] == known["_known"], "left_anti").alias("o")
    return (left.select(matched.alias("side"), *_wide(orders, details))
                .unionByName(lonely.select(F.lit("order").alias("side"), *_wide(orders, None))))


def dedup_pairs(wide: DataFrame) -> DataFrame:
    return wide.dropDuplicates(["order_id", "order_detail_id"])


def dedup_details(details: DataFrame) -> DataFrame:
    """Repeated sends of one detail collapse, as they would in a set."""
    return details.dropDuplicates(["order_id", "id"])


def _wide(orders: DataFrame | None, details: DataFrame | None) -> list[Column]:
    columns = []
    for field in schemas.ORDER_WIDE.fields:
        for alias, side, names in (("o", orders, _FROM_ORDER), ("d", details, _FROM_DETAIL)):
            source = names.get(field.name)
            if side is not None and source in side.columns:
                value = F.col(f"{alias}.{source}")
                break
        else:
            value = F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    return columns


def to_wide(pairs: DataFrame, orders: DataFrame, details: DataFrame, *extra: Column) -> DataFrame:
    """Wide rows of joined pairs; ``extra`` columns are carried along. Fields neither side
    delivers are NULL, which here means unknown, never 0."""
    return pairs.select(*_wide(orders, details), *extra)


def with_shares(wide: DataFrame) -> DataFrame:
    """Add, in cents, the detail's amount, its order's paid and original total, and the
    detail's proportional share."""
    part = money.cents(F.col("sku_price")) * F.col("sku_num")
    paid, total = money.cents(F.col("final_total_amount")), money.cents(F.col("original_total_amount"))
    staged = wide.withColumns({"_part": part, "_paid": paid, "_total": total})
    return staged.withColumn("_share", money.proportional(
        F.col("_paid"), F.col("_part"), F.col("_total")))


def order_sums(shares: DataFrame) -> DataFrame:
    """Per order: amounts and shares so far, and the detail that would close it. Grouped as
    ``same_key`` partitions, so that after a join on the order nothing is shuffled again."""
    return shares.groupBy(F.col("order_id").alias("_order"),
                          F.xxhash64("order_id").alias("_hash")).agg(
        F.sum("_part").alias("seen"), F.sum("_share").alias("given"),
        F.max("order_detail_id").alias("_last"),
        F.max("_paid").alias("_paid"), F.max("_total").alias("_total"))


def _settle(shares: DataFrame, sums: DataFrame) -> DataFrame:
    """Proportional shares; the closing detail of a completed order gets what is left."""
    closing = (sums.where(F.col("seen") == F.col("_total"))
               .select("_order", "_hash", "_last", (F.col("_paid") - F.col("given")).alias("_gap")))
    joined = shares.join(closing, (F.col("order_id") == F.col("_order"))
                         & (F.xxhash64("order_id") == F.col("_hash")), "left")
    rest = F.when(F.col("order_detail_id") == F.col("_last"), F.col("_gap")).otherwise(F.lit(0))
    return joined.withColumn("final_detail_amount", money.amount(F.col("_share") + rest))


def apportion(wide: DataFrame) -> DataFrame:
    """Fill ``final_detail_amount``: each detail's proportional share of the paid amount.

    Where an order's details add up to its original total, its last detail (largest id) takes
    the remainder, so that the shares add up to the paid amount to the cent. The remainder
    comes from per-order sums, which are combined before any shuffle.
    """
    shares = with_shares(wide)
    return _settle(shares, order_sums(shares)).select(*wide.columns)


def touch_sessions(touches: DataFrame, key: str, at: str, ttl: int) -> DataFrame:
    """Sessions of a key whose memory is refreshed by every touch and lost ``ttl`` seconds after the last:
    ``first_at``, ``last_at`` (seconds) and number of ``touches``. They are defined by the times of the
    touches, not by their arrival: a late one between two sessions makes them one. Tasks merge what they
    hold of a key before the shuffle."""
    kept = touches.groupBy(key, F.session_window(at, f"{ttl} seconds").alias("_w")).agg(
        F.min(at).alias("_first"), F.max(at).alias("_last"), F.count(F.lit(1)).alias("touches"))
    return kept.select(key, F.unix_seconds("_first").alias("first_at"), F.unix_seconds("_last").alias("last_at"),
                       "touches")


def apportion_sessions(wide: DataFrame, at: str, ttl: int = SUMS_TTL) -> DataFrame:
    """``apportion`` with running sums that are forgotten ``ttl`` seconds after an order's last detail
    (column ``at`` of the rows, a timestamp): an order whose details lie further apart starts anew, and
    only a session that adds up to the original total hands the remainder to its last detail."""
    return close_sessions(wide, session_closings(wide, at, ttl))


def session_closings(wide: DataFrame, at: str, ttl: int = SUMS_TTL) -> DataFrame:
    """The last details of the sessions that add up to their order's original total, and what is left."""
    window = F.session_window(at, f"{ttl} seconds").alias("_w")
    sums = with_shares(wide).groupBy(F.col("order_id").alias("_order"), window).agg(
        F.sum("_part").alias("seen"), F.sum("_share").alias("given"), F.max("order_detail_id").alias("_last"),
        F.max("_paid").alias("_paid"), F.max("_total").alias("_total"))
    return sums.where(F.col("seen") == F.col("_total")).select(
        "_order", "_last", (F.col("_paid") - F.col("given")).alias("_gap"))


def close_sessions(wide: DataFrame, closing: DataFrame) -> DataFrame:
    # Shuffled by the order alone, whose rows lie together and so take less room; its few closing details
    # are told apart behind the shuffle.
    shares, last = with_shares(wide), F.col("_last")
    joined = shares.join(closing, same_key(F.col("order_id"), F.col("_order"))
                         & F.col("order_detail_id").between(last, last), "left")
    paid = money.amount(F.col("_share") + F.coalesce("_gap", F.lit(0)))
    return joined.withColumn("final_detail_amount", paid).select(*wide.columns)


def order_amounts(wide: DataFrame) -> DataFrame:
    """Per order its day, the paid amount counted once per detail, and what its details' shares add
    up to: the paid amount if the order is complete, else the shares given. Nothing is settled by
    detail for that. Columns are named as in the wide rows."""
    sums = with_shares(wide).groupBy("order_id").agg(
        F.max("dt").alias("dt"), F.sum("final_total_amount").alias("final_total_amount"),
        F.sum("_part").alias("_seen"), F.sum("_share").alias("_given"),
        F.max("_paid").alias("_paid"), F.max("_total").alias("_total"))
    whole = F.coalesce(F.col("_seen") == F.col("_total"), F.lit(False))
    return sums.select("order_id", "dt", "final_total_amount", money.amount(
        F.when(whole, F.col("_paid")).otherwise(F.col("_given"))).alias("final_detail_amount"))


def apportion_onto(wide: DataFrame, before: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Apportion some of the details, going on from the running sums of earlier ones.

    ``wide`` carries the detail's time in seconds (``DETAIL_AT``); sums whose last detail is
    more than ``SUMS_TTL`` seconds older no longer count. Returns the rows and the sums to
    remember: of orders still incomplete, and of those that had sums before.
    """
    shares = with_shares(wide)
    times = shares.groupBy(F.col("order_id").alias("_order")).agg(
        F.min(DETAIL_AT).alias("_from"), F.max(DETAIL_AT).alias("_to"))
    old = before.select(F.col("order_id").alias("_old"), F.col("part").alias("_old_part"),
                        F.col("share").alias("_old_share"), F.col("last_at").alias("_old_at"))
    alive = ((F.col("_order") == F.col("_old"))
             & (F.col("_from") <= F.col("_old_at") + SUMS_TTL))
    sums = (order_sums(shares).join(times, "_order").join(old, alive, "left")
            .withColumns({"seen": F.col("seen") + F.coalesce("_old_part", F.lit(0)),
                          "given": F.col("given") + F.coalesce("_old_share", F.lit(0))}))
    rows = _settle(shares, sums).select(*[c for c in wide.columns if c != DETAIL_AT])
    open_ = ~F.coalesce(F.col("seen") == F.col("_total"), F.lit(False))
    kept = (sums.where(open_ | F.col("_old").isNotNull())
            .select(F.col("_order").alias("order_id"), F.col("seen").alias("part"),
                    F.col("given").alias("share"),
                    F.greatest("_to", "_old_at").alias("last_at")))
    return rows, kept
