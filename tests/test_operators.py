import random
from decimal import Decimal

import pytest
from pyspark.sql import Observation, functions as F

from tillstream.operators import dau, dwd, dws, keyed, search, serve

ORDER = "id long, user_id long, create_time string"


def flags(spark, orders, known=()):
    state = spark.createDataFrame([(str(u), c) for u, c in known],
                                  "user_id string, if_consumed string")
    got = dwd.first_order_flag(spark.createDataFrame(orders, ORDER), state)
    return {r.id: r.if_first_order for r in got.collect()}


@pytest.mark.parametrize("orders, known, want", [
    ([(1, 5, "b")], [], {1: "1"}),
    ([(1, 5, "b"), (2, 5, "a")], [], {1: "0", 2: "1"}),
    ([(1, 5, "b"), (2, 5, "a"), (3, 5, "c")], [], {1: "0", 2: "1", 3: "0"}),
    ([(2, 5, "a"), (1, 5, "a")], [], {1: "1", 2: "0"}),
    ([(1, 5, "b"), (2, 6, "a")], [(5, "1"), (6, "0")], {1: "0", 2: "1"}),
    ([(1, None, "b"), (2, None, "a")], [(5, "1")], {1: "0", 2: "0"}),
    ([(1, 5, "b"), (1, 5, "b"), (2, 5, "c")], [], {1: "1", 2: "0"})])
def test_first_order_flag(spark, orders, known, want):
    assert flags(spark, orders, known) == want


def test_first_visit_counts_before_and_after(spark):
    rows = [("m1", 5), ("m1", 3), ("m2", 9), ("m1", 3)]
    starts = spark.createDataFrame(
        [(m, "u", "a", "c", "v", "2024-01-01", "00", "00", t) for m, t in rows],
        "mid string, uid string, ar string, ch string, vc string, dt string, hr string, "
        "mi string, ts long")
    before, after = Observation(), Observation()
    got = dau.first_visit(starts, before, after).collect()
    assert {(r.mid, r.ts) for r in got} == {("m1", 3), ("m2", 9)}
    assert (before.get["rows"], after.get["rows"]) == (4, 2)


def test_latest_per_key_lets_the_later_row_win(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (1, 2, "c"), (None, 1, "d")],
                               "k long, v long, x string")
    got = {(r.k, r.x) for r in keyed.latest_per_key(df, ["k"], ["v"]).collect()}
    assert got == {(1, "b"), (None, "d")}


def test_only_keys_carries_no_hint(spark):
    table, keys = spark.range(100), spark.range(0, 100, 7)
    some = keyed.only_keys(table, keys, "id")
    assert sorted(some.collect()) == sorted(keys.collect())
    assert "ResolvedHint" not in some._jdf.queryExecution().analyzed().toString()


WIDE = ("order_id long, order_detail_id long, sku_price decimal(18,2), sku_num long, "
        "final_total_amount decimal(18,2), original_total_amount decimal(18,2), "
        "final_detail_amount decimal(18,2), detail_at long")


def wide(spark, rows):
    """Rows of (order, detail, price, number, paid, original total, detail's second)."""
    return spark.createDataFrame(
        [(o, d, Decimal(p), n, paid and Decimal(paid), total and Decimal(total), None, at)
         for o, d, p, n, paid, total, at in rows], WIDE)


def amounts(df):
    return {r.order_detail_id: None if r.final_detail_amount is None
            else str(r.final_detail_amount) for r in df.collect()}


@pytest.mark.parametrize("rows, want", [
    ([(1, 1, "9.99", 1, "5.00", "9.99", 0)], {1: "5.00"}),
    ([(1, i, "1.00", 1, "1.00", "3.00", 0) for i in (1, 2, 3)], {1: "0.33", 2: "0.33", 3: "0.34"}),
    # the order's details are not all here: plain proportional shares
    ([(1, i, "1.00", 1, "1.00", "4.00", 0) for i in (1, 2, 3)], {1: "0.25", 2: "0.25", 3: "0.25"}),
    # nothing to divide by: the last detail takes the paid amount
    ([(1, i, "0.00", 1, "2.00", "0.00", 0) for i in (1, 2)], {1: "0.00", 2: "2.00"}),
    ([(1, 1, "1.00", 1, "2.00", None, 0), (1, 2, "1.00", 1, "2.00", None, 0)], {1: None, 2: None})])
def test_apportion(spark, rows, want):
    assert amounts(dws.apportion(wide(spark, rows)).drop("detail_at")) == want


def test_apportion_in_parts_adds_up(spark):
    """Random orders cut into random parts: every cent is handed out, and one part only gives
    what the whole gives."""
    rng = random.Random(5)
    rows = []
    for o in range(40):
        prices = [rng.randint(1, 9999) for _ in range(rng.randint(1, 6))]
        total = sum(prices)
        rows += [(o, o * 10 + i, str(Decimal(p) / 100), 1, str(Decimal(rng_paid) / 100),
                  str(Decimal(total) / 100), i * 100)
                 for rng_paid in [rng.randint(1, 10**6)] for i, p in enumerate(prices)]
    whole = amounts(dws.apportion(wide(spark, rows)))
    sums = spark.createDataFrame([], dws.RUNNING_SUMS)
    assert amounts(dws.apportion_onto(wide(spark, rows), sums)[0]) == whole
    parted = {}
    for part in range(3):
        some = [r for r in rows if r[1] % 3 == part]
        done, kept = dws.apportion_onto(wide(spark, some), sums)
        parted.update(amounts(done))
        fresh = [tuple(r) for r in kept.collect()]
        old = [tuple(r) for r in sums.collect() if r.order_id not in {f[0] for f in fresh}]
        sums = spark.createDataFrame(old + fresh, dws.RUNNING_SUMS)
    for o in range(40):
        paid = next(Decimal(r[4]) for r in rows if r[0] == o)
        assert sum(Decimal(v) for d, v in parted.items() if d // 10 == o) == paid


def test_running_sums_expire(spark):
    sums = spark.createDataFrame([(1, 100, 50, 0)], dws.RUNNING_SUMS)
    for at, want in ((1000, "0.50"), (1001, "0.50")):
        rows = wide(spark, [(1, 2, "1.00", 1, "1.01", "2.00", at)])
        done, kept = dws.apportion_onto(rows, sums)
        got = amounts(done)[2]
        # in time: 1.01 - 0.50 remain; too late: a plain share of 0.505, rounded up
        assert got == "0.51"
        assert [tuple(r) for r in kept.collect()] == (
            [(1, 200, 101, 1000)] if at == 1000 else [(1, 100, 51, 1001)])


def pairs(spark, orders, details):
    o = spark.createDataFrame(orders, "id long, t string").select(
        "id", F.to_timestamp("t").alias("event_time"))
    d = spark.createDataFrame(details, "id long, order_id long, t string").select(
        "id", "order_id", F.to_timestamp("t").alias("event_time"))
    return o, d


def test_hop_join_equals_windows_joined_and_deduplicated(spark):
    rng = random.Random(3)
    stamp = lambda s: f"2024-01-01 00:{s // 60:02d}:{s % 60:02d}"
    o, d = pairs(spark, [(i, stamp(rng.randint(0, 300))) for i in range(60)],
                 [(1000 + i, i % 60, stamp(rng.randint(0, 300))) for i in range(600)])
    hop = {(r[0], r[1]) for r in dws.hop_join(o, d).select("o.id", "d.id").collect()}
    cut = lambda df: df.withColumn("w", F.window("event_time", "15 seconds", "5 seconds"))
    wo, wd = cut(o).alias("o"), cut(d).alias("d")
    both = wo.join(wd, (F.col("o.id") == F.col("d.order_id")) & (F.col("o.w") == F.col("d.w")))
    assert hop == {(r[0], r[1]) for r in both.select("o.id", "d.id").distinct().collect()}


def test_interval_join_includes_its_bounds(spark):
    o, d = pairs(spark, [(1, "2024-01-01 00:20:00")],
                 [(i, 1, t) for i, t in enumerate(["2024-01-01 00:10:00", "2024-01-01 00:09:59",
                                                   "2024-01-01 00:30:00", "2024-01-01 00:30:01"])])
    assert sorted(r[0] for r in dws.interval_join(o, d).select("d.id").collect()) == [0, 2]


def test_full_outer_keeps_both_lonely_sides(spark):
    o, d = pairs(spark, [(1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:00")],
                 [(11, 1, "2024-01-01 00:00:00"), (12, 1, "2024-01-01 00:00:00"),
                  (31, 3, "2024-01-01 00:00:00"), (41, None, "2024-01-01 00:00:00")])
    got = {(r.side, r.order_id, r.order_detail_id) for r in dws.full_outer_pairs(o, d).collect()}
    assert got == {("both", 1, 11), ("both", 1, 12), ("order", 2, None), ("detail", None, 31),
                   ("detail", None, 41)}


def test_unknown_metric_has_no_hours(spark):
    table = spark.createDataFrame([("2024-01-02", "m", "03")], "dt string, mid string, hr string")
    assert serve.realtime_hour(table, "2024-01-02", "other").count() == 0
    assert serve.realtime_hour_json(table, "2024-01-02", "other").first().json is None
    assert serve.realtime_hour_json(table, "2024-01-02").first().json == \
        '{"yesterday":{},"today":{"03":1}}'
    assert serve.order_amount_total(
        spark.createDataFrame([], "dt string, final_total_amount decimal(18,2)"),
        "2024-01-02").first().sum_amount is None


def test_match_by_word_and_page(spark):
    docs = spark.createDataFrame(
        [(1, "Red Planet", 3.0), (2, "redo", 1.0), (3, "the RED-line", 2.0), (4, None, 1.0)],
        "id long, name string, score double")
    found = search.match(docs, "name", "red")
    assert [r.id for r in search.top(found, "score", "id").collect()] == [3, 1]
    assert [r.id for r in search.top(found, "score", "id", 1, 1).collect()] == [1]
    assert [r.id for r in search.top(found, "score", "id", descending=True).collect()] == [1, 3]
