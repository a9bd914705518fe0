"""What a batch of pairs shuffles and stores."""

from decimal import Decimal as D

from pyspark.sql import functions as F

from tests.test_streams import DETAIL, ORDER, at, both, feeds, store  # noqa: F401
from tillstream.operators import dws
from tillstream.plans import views
from tillstream.sinks import tables
from tillstream.streaming import ledger, pairs


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_table_without_files_costs_no_shuffle(spark, tmp_path):
    rows = spark.range(100).withColumn("text", F.md5(F.col("id").cast("string")))
    known = tables.read_slots(spark, str(tmp_path / "none"), rows.schema)
    assert known.count() == 0
    assert "Exchange" not in plan_of(rows.join(known.select("id"), "id", "left_anti"))


def test_amounts_are_settled_without_a_shuffle_of_their_own(spark, tmp_path, feeds):  # noqa: F811
    """Orders whose amounts are unknown store nothing, as ever."""
    held = store(spark, tmp_path, feeds)
    orders = [(1, 1, 3, 3, at(0)), (2, 1, None, None, at(0))]
    details = [(10, 1, 1, 1, at(1)), (11, 1, 2, 1, at(2)), (20, 2, 1, 1, at(1))]
    rows = pairs.side_by_side(spark.createDataFrame(orders, ORDER.replace("decimal(18,2)", "long")).selectExpr(
        "id", "user_id", "cast(final_total_amount AS decimal(18,2)) final_total_amount",
        "cast(original_total_amount AS decimal(18,2)) original_total_amount", "create_time"),
        spark.createDataFrame(details, DETAIL.replace("decimal(18,2)", "long")).selectExpr(
            "id", "order_id", "cast(order_price AS decimal(18,2)) order_price", "sku_num", "create_time"))
    pairs.settle(held, pairs.interval_pairs(held, rows, 0), 0)
    assert held.all_new(0)
    assert sorted((r.order_detail_id, int(r.final_detail_amount)) for r in pairs.settled(held).collect()) == [
        (10, 1), (11, 2)]
    assert "Exchange" not in plan_of(pairs.settled(held))


def test_the_log_keeps_a_pair_once_and_its_reader_shuffles_no_wide_rows(spark, tmp_path, feeds):  # noqa: F811
    held = store(spark, tmp_path, feeds)
    ledger.write(held, both(spark, feeds, [(1, 1, None, None, at(0)), (2, 1, None, None, at(5000))],
                            [(10, 1, None, 1, at(1)), (30, 3, None, 1, at(2))]), 0)
    log = tables.read_slots(spark, held.table("ledger"), ledger.LEDGER)
    assert [(r.side, r.order_id) for r in log.collect()] == [("detail", 3)]
    now = ledger.read(held)
    assert sorted((r.side, r.order_id, r.order_detail_id) for r in now.collect()) == [
        ("both", 1, 10), ("detail", 3, 30)]
    assert "Exchange" not in plan_of(now)


def test_details_in_sequence_are_the_details(spark, tmp_path, sf_dir):
    """Also where an order comes twice, has no day or no id."""
    names = ("lineitem", "orders", "part")
    lineitem, orders, part = (views.load(spark, sf_dir, t) for t in names)
    lineitem = lineitem.where("l_orderkey < 40").withColumn(
        "l_orderkey", F.when(F.col("l_linenumber") < 6, F.col("l_orderkey")))
    orders = orders.where("o_orderkey < 30").withColumn(
        "o_orderdate", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderdate")))
    orders = orders.unionAll(orders.where("o_orderkey < 5")).withColumn(
        "o_orderkey", F.when(F.col("o_orderkey") != 7, F.col("o_orderkey")))
    for table, rows in zip(names, (lineitem, orders, part)):
        rows.write.parquet(str(tmp_path / f"{table}.parquet"))
    got = views.details_in_sequence(spark, str(tmp_path))
    want = views.order_detail(spark, str(tmp_path))
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 20


def test_pairs_known_to_come_once_are_read_without_a_shuffle(spark, tmp_path, feeds, monkeypatch):  # noqa: F811
    held = store(spark, tmp_path, feeds)
    for n, (order, detail) in enumerate([(1, 10), (2, 20)]):
        rows = both(spark, feeds, [(order, 1, None, None, at(0))], [(detail, order, None, 1, at(1))])
        pairs.store_pairs(held, pairs.interval_pairs(held, rows, n), n)
    counted = []
    monkeypatch.setattr(pairs, "repeats", lambda *_: counted.append(1))
    assert sorted(r.order_id for r in pairs.read_pairs(held).collect()) == [1, 2]
    assert pairs.lonely(held, pairs.read_pairs(held)).count() == 0 and not counted
    # Somebody who has not seen the batches come has to count.
    pairs.read_pairs(store(spark, tmp_path, feeds))
    assert counted


def test_a_detail_that_meets_two_known_versions_counts_once(spark, tmp_path, feeds):  # noqa: F811
    """The batch's own keys are all new; those that it meets came twice."""
    held = store(spark, tmp_path, feeds)
    for n, (orders, details) in enumerate([([(1, 1, 3, 3, at(0))], []), ([(1, 1, 3, 3, at(5))], []),
                                           ([], [(10, 1, 1, 1, at(1)), (11, 1, 2, 1, at(2))])]):
        money = [[tuple(D(v) if 2 <= i < last else v for i, v in enumerate(r)) for r in rows]
                 for rows, last in ((orders, 4), (details, 3))]
        batch = both(spark, feeds, *money)
        pairs.settle(held, pairs.interval_pairs(held, batch, n), n)
    assert not held.all_new(2) and not held.unique("wide")
    assert sorted((r.order_detail_id, int(r.final_detail_amount)) for r in pairs.settled(held).collect()) == [
        (10, 1), (11, 2)]


def test_stored_rows_have_their_time_once(spark, tmp_path, feeds):  # noqa: F811
    held = store(spark, tmp_path, feeds)
    batch = both(spark, feeds, [(1, 1, None, None, at(7))], [(10, 1, None, 1, at(3))])
    pairs.store_pairs(held, pairs.interval_pairs(held, batch, 0, timed=True), 0)
    assert "event_time" not in spark.read.parquet(held.table("d")).columns
    assert [str(r.event_time) for r in held.known("d").collect()] == ["2024-01-01 00:00:03"]
    assert [r.detail_after for r in spark.read.parquet(held.table("pairs")).collect()] == [-4]


def test_closing_details_are_found_with_the_rows_of_an_order_together(spark):
    """Two sessions of one order, each adding up to the whole."""
    rows = [(1, 10, 100, 1, 100), (1, 11, 200, 1, 110), (1, 12, 300, 1, 900), (2, 20, 100, 1, 100)]
    wide = spark.createDataFrame(rows, "order_id long, order_detail_id long, p long, sku_num long, sec long").selectExpr(
        "order_id", "order_detail_id", "cast(p / 100 as decimal(18,2)) sku_price", "sku_num",
        "cast(1 as decimal(18,2)) final_total_amount", "cast(3 as decimal(18,2)) original_total_amount",
        "timestamp_seconds(sec) at", "cast(null as decimal(18,2)) final_detail_amount")
    done = dws.apportion_sessions(wide, "at", 100)
    assert sorted((r.order_detail_id, str(r.final_detail_amount)) for r in done.collect()) == [
        (10, "0.33"), (11, "0.67"), (12, "1.00"), (20, "0.33")]
    shuffles = [line for line in plan_of(done).splitlines() if "Exchange hashpartitioning" in line]
    assert shuffles and not any("order_detail_id" in line or "_last" in line for line in shuffles)


def test_orders_in_sequence_are_the_orders(spark, tmp_path, sf_dir):
    """Also where a product comes twice or is unknown, an order twice, without id, day or lines; one exchange of the lines."""
    names = ("lineitem", "orders", "part")
    lineitem, orders, part = (views.load(spark, sf_dir, t) for t in names)
    lineitem = lineitem.where("l_orderkey < 40 and l_orderkey <> 11").withColumn(
        "l_orderkey", F.when(F.col("l_linenumber") < 6, F.col("l_orderkey")))
    orders = orders.where("o_orderkey < 30").withColumn(
        "o_orderdate", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderdate")))
    orders = orders.unionAll(orders.where("o_orderkey < 5")).withColumn(
        "o_orderkey", F.when(F.col("o_orderkey") % 7 > 0, F.col("o_orderkey")))
    part = part.where("p_partkey % 3 > 0")
    part = part.unionAll(part.where("p_partkey % 2 = 0"))
    for table, rows in zip(names, (lineitem, orders, part)):
        rows.write.parquet(str(tmp_path / f"{table}.parquet"))
    sides = views.sides_in_sequence(spark, str(tmp_path))
    for side, want in (("o", views.order_info(spark, str(tmp_path))),
                       ("d", views.order_detail(spark, str(tmp_path)).drop("event_time"))):
        got = sides.where(F.col(side).isNotNull()).select(f"{side}.*")
        assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 20
    assert plan_of(sides).count("Exchange rangepartitioning") == 1
