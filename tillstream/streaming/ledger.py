"""A full outer join of orders and details as a log: pairs as they are found, lonely rows once it is
certain that nothing on time can still meet them.

The stream's clock is the latest time of any row so far. A row's wait has passed when the clock is more
than ``wait`` seconds past it. If it has met no partner by then, it goes out alone; if a late partner
comes after all, a further row withdraws it (``gone``). What holds in the end is a matter of the rows
and not of how they were cut into batches: the pairs, and every row without one whose wait has passed.

The pairs of the log are the table of pairs itself; lonely rows and withdrawals have a table of their own.
Rows that still wait lie in folders by the hour of their time. A batch opens those hours that its clock
has passed, and the folders of the orders it speaks about.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillstream import schemas
from tillstream.operators import dws
from tillstream.operators.keyed import earliest_per_key, same_key
from tillstream.sinks import tables as sink_tables
from tillstream.streaming import pairs
from tillstream.streaming.pairs import PairStore, SLOT

LEDGER = T.StructType([T.StructField("side", T.StringType()), T.StructField("event_time", T.TimestampType()),
                       T.StructField("gone", T.BooleanType()), *schemas.ORDER_WIDE.fields])
_CLOCK = T.StructType([T.StructField("at", T.LongType())])
_KEYS = {"order": ["order_id"], "detail": ["order_id", "order_detail_id"]}
_HOUR = "hour"
# Pairs, and details without one when they came.
_SIDES = "sides"
_PAIRS, _ALONE = f"{_SIDES}/side=both", f"{_SIDES}/side=detail"


def _slots(store: PairStore, rows: DataFrame, *ids: Column) -> list[int]:
    """The folders of some order ids: few numbers."""
    slot = F.explode(F.array(*[store.slot_of(i) for i in ids])).alias(SLOT)
    return [r[0] for r in rows.select(slot).distinct().collect() if r[0] is not None]


def _seconds(at: str) -> Column:
    return F.unix_seconds(F.col(at))


def _orders(store: PairStore, n: int, slots: list[int]) -> DataFrame:
    """The orders that batch ``n`` has stored, each as it would go out alone."""
    rows = store.known("o", slots=slots, only=n)
    alone = dws.to_wide(rows.alias("o"), rows, None, F.lit("order").alias("side"),
                        F.col("o.event_time").alias("event_time"), F.lit(False).alias("gone"))
    return alone.select(*LEDGER.names)


def _details(store: PairStore, n: int, slots: list[int]) -> DataFrame:
    """The details of batch ``n`` that have met no order."""
    rows = sink_tables.read_slots(store.spark, store.table(_ALONE), LEDGER, slots, only_batch=n)
    return rows.withColumns({"side": F.lit("detail"), "gone": F.lit(False)}).select(*LEDGER.names)


def _latest(store: PairStore, n: int, slots: dict[str, list[int]]) -> int | None:
    """The latest time of the rows that batch ``n`` has stored."""
    times = [store.known(side, slots=slots[side], only=n).select("event_time") for side in slots]
    return times[0].unionAll(times[1]).agg(F.max(_seconds("event_time"))).first()[0]


def _clock(store: PairStore, n: int) -> int | None:
    """The clock that batch ``n`` left, in seconds; batches are numbered without gaps from 0."""
    if n < 0:
        return None
    return sink_tables.read_batch(store.spark, store.table("clock"), _CLOCK, n).first()[0]


def _met(rows: DataFrame, side: str, found: DataFrame, how: str) -> DataFrame:
    """Rows of one side that have a partner among ``found`` (``left_semi``), or none (``left_anti``)."""
    keys = _KEYS[side]
    partners = found.select(*[F.col(k).alias(f"_{k}") for k in keys])
    partners = partners.distinct() if side == "order" else partners  # an order has many
    on = same_key(F.col(keys[-1]), F.col(f"_{keys[-1]}"))
    for key in keys[:-1]:
        on = on & (F.col(key) == F.col(f"_{key}"))
    return rows.where(F.col("side") == side).join(partners, on, how)


def write(store: PairStore, batch: DataFrame, n: int, wait: int = dws.CACHE_WAIT) -> None:
    """Take in batch ``n`` of orders and details (``pairs.side_by_side``) and add to the log what it makes
    certain. The same batch again replaces what it wrote."""
    spark, wide = store.spark, schemas.ORDER_WIDE
    pairs.store_sides(store, pairs.interval_sides(store, batch, n, wait), n, _SIDES)
    brought = {side: store.brought[side][2] for side in "od"}
    slots = sorted({*brought["o"], *brought["d"]})
    orders, details = _orders(store, n, slots), _details(store, n, slots)
    fresh = orders.unionAll(details)
    found = sink_tables.read_slots(spark, store.table(_PAIRS), wide, slots, only_batch=n).select(*wide.names)

    before, own = _clock(store, n - 1), _latest(store, n, brought)
    now = max((at for at in (before, own) if at is not None), default=None)
    sink_tables.append_table(spark.createDataFrame([(now,)], _CLOCK), store.table("clock"), n, None)
    if now is None:
        return
    passed = _seconds("event_time") < now - wait
    hour = F.floor(_seconds("event_time") / 3600).cast("long")
    sink_tables.append_slots(fresh.where(~passed).withColumn(_HOUR, hour), store.table("waiting"), n, _HOUR)

    # Of earlier batches, the rows that the clock has passed since; of this one, all it has passed.
    due = fresh.where(passed)
    alone = None
    if store.all_new(n):
        # Their other versions could have met an order, but there are none.
        due, alone = orders.where(passed), details.where(passed)
    if before is not None and before < now:
        span = ((before - wait) // 3600, (now - wait) // 3600)
        hours = [h for h in sink_tables.slots_present(spark, store.table("waiting"), _HOUR)
                 if span[0] <= h <= span[1]]
        waiting = sink_tables.read_slots(spark, store.table("waiting"), LEDGER, hours, n, slot=_HOUR)
        since = _seconds("event_time") >= before - wait
        due = due.unionByName(waiting.where(since & passed).select(*LEDGER.names))
    partners = sink_tables.read_slots(spark, store.table(_PAIRS), wide,
                                      _slots(store, due, F.col("order_id")), n + 1)
    sent = sink_tables.read_slots(spark, store.table("ledger"), LEDGER, slots, n)
    entries = [] if alone is None else [alone]
    for side in _KEYS:
        late = _met(sent.where(~F.col("gone")).select(*LEDGER.names), side, found, "left_semi")
        entries += [_met(due, side, partners, "left_anti"), late.withColumn("gone", F.lit(True))]
    entries = reduce(DataFrame.unionByName, entries)
    sink_tables.append_slots(entries.withColumn(SLOT, store.slot_of(F.col("order_id"))),
                             store.table("ledger"), n)


def _last(log: DataFrame, side: str) -> DataFrame:
    """The entries of one side that hold. Wide rows are only compared if some row has several entries."""
    log = log.where(F.col("side") == side)
    if not pairs.repeats(log, *_KEYS[side]):
        return log.where(~F.col("gone"))
    # A withdrawal sorts before everything else of its row.
    log = log.withColumn("_stays", ~F.col("gone"))
    return earliest_per_key(log, _KEYS[side], ["_stays", "event_time", "create_time"]).where("_stays")


def read(store: PairStore) -> DataFrame:
    """What holds now: pairs, lonely orders and lonely details, wide rows with their ``side``; of several
    versions the earliest."""
    columns = ["side", *schemas.ORDER_WIDE.names]
    log = sink_tables.read_slots(store.spark, store.table("ledger"), LEDGER).select(*LEDGER.names)
    parts = [pairs.read_pairs(store, _PAIRS).withColumn("side", F.lit("both")), *[_last(log, side) for side in _KEYS]]
    return reduce(DataFrame.unionByName, [part.select(*columns) for part in parts])
