"""Streams cut into micro-batches give what the batch operators give on the whole."""

import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillstream import schemas
from tillstream.operators import dau, dws
from tillstream.sinks import tables
from tillstream.streaming import batch_log, first_orders, ledger, pairs, runtime, state


class Feed:
    """A folder of parquet files that arrive in the order they are added."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema, self.count = spark, str(folder), schema, 0
        os.makedirs(self.folder)

    def add(self, rows):
        part = f"{self.folder}/.part{self.count}"
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.parquet(part)
        name = next(n for n in os.listdir(part) if n.endswith(".parquet"))
        target = f"{self.folder}/{self.count}.parquet"
        os.link(f"{part}/{name}", target)
        stamp = 1_700_000_000 + 10 * self.count
        os.utime(target, (stamp, stamp))
        self.count += 1

    def stream(self):
        return (self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1)
                .parquet(self.folder))


def run(stream, write, tmp_path):
    return runtime.finish(runtime.start(stream, write, str(tmp_path / "checkpoint"), drain=True), 300)


DAY = 1_704_067_200_000


def start_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        ts = DAY + rng.randint(0, 3 * 86_400_000)
        rows.append((f"m{rng.randint(0, 9)}", "u", "a", "c", "v", ts))
    return sorted(rows, key=lambda r: r[-1])


def as_starts(spark, rows):
    from tillstream.functions import clock
    shape = "mid string, uid string, ar string, ch string, vc string, ts long"
    df = spark.createDataFrame(rows, shape)
    return df.select("mid", "uid", "ar", "ch", "vc", *clock.day_hour_minute(F.col("ts")), "ts")


def test_first_visits_in_parts_equal_the_whole(spark, tmp_path):
    """In no order at all, with repeats, and with one log of the far future in the first part."""
    rows = start_rows(120, 1) + [("m1", "u", "a", "c", "v", DAY + 400_000_000_000)]
    random.Random(2).shuffle(rows)
    feed = Feed(spark, tmp_path / "in", schemas.DAU_INFO)
    for part in (rows[-1:] + rows[:50], rows[30:90], rows[90:]):
        feed.add(as_starts(spark, part).collect())
    table = str(tmp_path / "dau")
    run(feed.stream(), lambda batch, n: state.store_visits(batch, n, table), tmp_path)
    got = state.read_visits(spark, table).collect()
    assert sorted(got) == sorted(dau.first_visit(as_starts(spark, rows)).collect())
    tables.compact(spark, table, schemas.DAU_INFO, state.VISIT, 99, "dt", earliest=state.VISIT_ORDER)
    folded = state.read_visits(spark, table)
    assert sorted(folded.collect()) == sorted(got)
    assert "Aggregate" not in folded._jdf.queryExecution().executedPlan().toString()


ORDER = "id long, user_id long, final_total_amount decimal(18,2), original_total_amount decimal(18,2), create_time string"
DETAIL = "id long, order_id long, order_price decimal(18,2), sku_num long, create_time string"


def at(second):
    return f"2024-01-01 {second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d}"


@pytest.fixture
def feeds(spark, tmp_path):
    from pyspark.sql.types import _parse_datatype_string
    return (Feed(spark, tmp_path / "o", _parse_datatype_string(ORDER)),
            Feed(spark, tmp_path / "d", _parse_datatype_string(DETAIL)))


def sales(n, seed):
    from decimal import Decimal as D
    rng = random.Random(seed)
    orders, details = [], []
    for i in range(n):
        second, lines = 60 * i, rng.randint(1, 4)
        prices = [D(rng.randint(1, 9999)) / 100 for _ in range(lines)]
        orders.append((i, i % 7, D(rng.randint(1, 99999)) / 100, sum(prices), at(second)))
        details += [(i * 10 + k, i, p, 1, at(second + rng.randint(0, 40)))
                    for k, p in enumerate(prices)]
    return orders, details


def fill(feeds, orders, details, parts=3, seed=0):
    """Both sides in no order, some rows sent twice."""
    for feed, rows in zip(feeds, (orders, details)):
        rows = [*rows, *rows[:5]]
        random.Random(seed).shuffle(rows)
        for p in range(parts):
            feed.add(rows[p::parts])


def store(spark, tmp_path, feeds, name="store"):
    return pairs.PairStore(spark, str(tmp_path / name), feeds[0].schema, feeds[1].schema, 5)


FUTURE = (777, 1, None, None, "2199-01-01 00:00:00")


@pytest.mark.parametrize("pair, batch", [(pairs.interval_pairs, dws.interval_join),
                                         (pairs.hop_pairs, dws.hop_join)])
def test_paired_streams_equal_the_batch_join(spark, tmp_path, feeds, pair, batch):
    orders, details = sales(12, 4)
    feeds[0].add([FUTURE, (778, 1, None, None, "no time"), (None, 1, None, None, at(0))])
    fill(feeds, orders, details)
    held, got = store(spark, tmp_path, feeds), {}

    def write(rows, n):
        for _ in range(2):      # as if the first attempt had failed just before its commit
            got[n] = pair(held, rows, n).select("order_id", "order_detail_id").collect()

    run(pairs.side_by_side(feeds[0].stream(), feeds[1].stream()), write, tmp_path)
    found = sorted(tuple(r) for rows in got.values() for r in rows)
    timed = [spark.createDataFrame(rows, shape).withColumn("event_time", F.to_timestamp("create_time"))
             for rows, shape in ((orders, ORDER), (details, DETAIL))]
    want = batch(*timed).select("o.id", "d.id").collect()
    assert found == sorted(tuple(r) for r in want) and found and len(got) > 2
    assert pairs.undated(held).count() == 2
    alone = pairs.lonely(held, spark.createDataFrame(found, "order_id long, order_detail_id long"))
    met = [{f[i] for f in found} for i in (0, 1)]
    assert {(r.side, r.order_id, r.order_detail_id) for r in alone.collect()} == (
        {("order", o[0], None) for o in [*orders, FUTURE] if o[0] not in met[0]}
        | {("detail", None, d[0]) for d in details if d[0] not in met[1]})


def test_amounts_split_over_batches_equal_the_whole(spark, tmp_path, feeds):
    """Shares, and the detail that takes an order's remainder, are those of the whole."""
    orders, details = sales(12, 6)
    fill(feeds, orders, details, seed=3)
    held = store(spark, tmp_path, feeds)

    def write(rows, n):
        for _ in range(2):
            found = runtime.staged(pairs.interval_pairs(held, rows, n), str(tmp_path / "staged"), n)
            pairs.settle(held, found, n)

    query = run(pairs.side_by_side(feeds[0].stream(), feeds[1].stream()), write, tmp_path)
    rows = pairs.settled(held).collect()
    o, d = spark.createDataFrame(orders, ORDER), spark.createDataFrame(details, DETAIL)
    whole = dws.apportion(dws.to_wide(dws.batch_join(o, d), o, d))
    amounts = lambda some: sorted((r.order_detail_id, r.final_detail_amount) for r in some)
    assert amounts(rows) == amounts(whole.collect())
    for order in orders:
        assert sum(r.final_detail_amount for r in rows if r.order_id == order[0]) == order[2]
    assert len(runtime.progress(query)) == 2


def both(spark, feeds, orders, details):
    return pairs.side_by_side(spark.createDataFrame(orders, feeds[0].schema),
                              spark.createDataFrame(details, feeds[1].schema))


def test_a_batch_lists_the_folders_of_its_rows_only(spark, tmp_path, feeds):
    """After batches that had folders of their own, a batch of one order lists one folder."""
    held = store(spark, tmp_path, feeds)
    for n in range(4):
        pairs.interval_pairs(held, both(spark, feeds, [(5 * n, 1, None, None, at(n))],
                                        [(n, 5 * n, None, 1, at(n))]), n)
    known = held.known("d", 20, [3])
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "(1 paths)" in plan and known.count() == 1
    assert len(known.inputFiles()) == 1 and "/slot=3/batch=3/" in known.inputFiles()[0]
    found = pairs.interval_pairs(held, both(spark, feeds, [], [(99, 15, None, 1, at(1))]), 20)
    assert [tuple(r) for r in found.select("order_id", "order_detail_id").collect()] == [(15, 99)]


def test_repeats_are_dropped_and_versions_kept(spark, tmp_path, feeds):
    twice = [(1, 1, None, None, at(0)), (1, 1, None, None, at(18_000)), (2, 1, None, None, at(0)),
             (2, 1, None, None, at(0)), (3, 1, None, None, "no time")]
    held = store(spark, tmp_path, feeds)
    for n in (0, 1):
        pairs.interval_pairs(held, both(spark, feeds, twice, []), n)
    assert sorted(r.id for r in held.known("o", 9).collect()) == [1, 1, 2]
    assert sorted(r.order_id for r in pairs.lonely(held, held.known("o").selectExpr(
        "id AS order_id", "id AS order_detail_id").where("order_id > 9")).collect()) == [1, 2]


DAY_END = ("2024-01-01 23:59:00", "2024-01-01 23:59:30", "2024-01-02 00:01:00")


@pytest.mark.parametrize("cuts", [[[0, 1, 2]], [[0, 1], [2]], [[0], [1, 2]], [[2], [1], [0]], [[2, 0], [1]]])
def test_a_row_sent_again_with_another_time_makes_one_pair(spark, tmp_path, feeds, cuts):
    rows = {0: ("o", (1, 1, None, None, DAY_END[0])), 1: ("d", (7, 1, None, 1, DAY_END[1])),
            2: ("o", (1, 1, None, None, DAY_END[2]))}
    held = store(spark, tmp_path, feeds)
    for n, cut in enumerate(cuts):
        some = [[rows[i][1] for i in cut if rows[i][0] == side] for side in "od"]
        pairs.store_pairs(held, pairs.interval_pairs(held, both(spark, feeds, *some), n), n)
    got = pairs.read_pairs(held).select("order_id", "order_detail_id", "create_time").collect()
    assert [tuple(r) for r in got] == [(1, 7, DAY_END[0])]


@pytest.mark.parametrize("seed, parts", [(1, 1), (2, 3), (3, 5)])
def test_pairs_and_amounts_do_not_depend_on_versions_or_cuts(spark, tmp_path, feeds, seed, parts):
    """A third of the rows is sent again, earlier or later by up to an hour, in any file."""
    orders, details = sales(20, 8)
    rng = random.Random(8)
    moved = lambda r: (*r[:-1], at(max(0, 60 * r[0 if r in orders else 1] + rng.randint(-3600, 3600))))
    sent = [("o", r) for r in orders + [moved(r) for r in orders[::3]]]
    sent += [("d", r) for r in details + [moved(r) for r in details[::3]]]
    rng.shuffle(sent)
    random.Random(seed).shuffle(sent)
    held = store(spark, tmp_path, feeds)
    for n in range(parts):
        some = [[r for s, r in sent[n::parts] if s == side] for side in "od"]
        for _ in range(2):
            found = runtime.staged(pairs.interval_pairs(held, both(spark, feeds, *some), n),
                                   str(tmp_path / "staged"), n)
            pairs.store_pairs(held, found, n)
            pairs.settle(held, found, n)
    seconds = lambda r: sum(int(x) * f for x, f in zip(r[-1][11:].split(":"), (3600, 60, 1)))
    want = {}
    for o in (r for s, r in sent if s == "o"):
        for d in (r for s, r in sent if s == "d" and r[1] == o[0]):
            if abs(seconds(o) - seconds(d)) <= dws.CACHE_WAIT:
                want[o[0], d[0]] = min(o[-1], want.get((o[0], d[0]), "9"))
    got = {(r.order_id, r.order_detail_id): r.create_time for r in pairs.read_pairs(held).collect()}
    assert got == want
    settled = pairs.settled(held).collect()
    assert {(r.order_id, r.order_detail_id): r.create_time for r in settled} == want
    whole = dws.apportion(pairs.read_pairs(held)).collect()
    amounts = lambda some: sorted((r.order_detail_id, r.final_detail_amount) for r in some)
    assert amounts(settled) == amounts(whole)


def test_one_user_opens_one_folder(spark, tmp_path):
    table = str(tmp_path / "users")
    users = spark.range(2000).select(F.col("id").cast("string").alias("user_id"),
                                     F.lit("1").alias("if_consumed"))
    tables.upsert(users, table, ["user_id"], 0, slots=state.USER_SLOTS)
    one = spark.createDataFrame([("7",)], "user_id string")
    slots = tables.slots_of(one, "user_id", state.USER_SLOTS)
    known = tables.read_batches(spark, table, schemas.USER_STATE, 1, slots=slots)
    assert len(slots) == 1 and known.where("user_id = '7'").count() == 1
    assert known.count() < 2000 / state.USER_SLOTS * 3
    assert len(os.listdir(f"{table}/gen=0/batch=0")) > state.USER_SLOTS
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "slot" in plan.split("PartitionFilters")[1].split("]")[0]


HEAD = "id long, user_id long, create_time string"


def flag_run(spark, feed, tmp_path, name, before=None, by_time=False):
    """Drain the feed into a table of flags; the flags now, and what each batch gave."""
    table, seen = str(tmp_path / f"{name}-flags"), {}

    def write(batch, n):
        first_orders.store_flags(batch, n, table)
        seen[n] = sorted((r.id or 0, r.if_first_order) for r in batch.collect())

    flagged = first_orders.flag(feed.stream(), before, by_time)
    runtime.finish(runtime.start(flagged, write, str(tmp_path / name), drain=True, state_partitions=2), 300)
    return {r.id: r.if_first_order for r in first_orders.read_flags(spark, table).collect()}, seen


@pytest.fixture
def heads(spark, tmp_path):
    from pyspark.sql.types import _parse_datatype_string
    return Feed(spark, tmp_path / "heads", _parse_datatype_string(HEAD))


def test_first_flags_move_when_an_earlier_order_arrives_late(spark, tmp_path, heads):
    for rows in ([(1, 5, at(50)), (2, 5, at(60)), (3, None, at(1)), (8, 6, at(9)), (None, 6, at(1))],
                 [(4, 5, at(10)), (4, 5, at(10)), (5, None, at(0)), (9, 6, at(10)), (10, 3, None)],
                 [(6, 5, at(30)), (7, 7, at(30)), (8, 6, at(9)), (11, 2, at(1))],
                 [(8, 6, at(99)), (10, 3, at(7))]):      # sent again, with other times
        heads.add(rows)
    before = spark.createDataFrame([("2",), (None,), ("no number",)], "user_id string")
    flags, _ = flag_run(spark, heads, tmp_path, "time", before, by_time=True)
    assert {i for i, f in flags.items() if f == "1"} == {4, 7, 8, 10}
    assert set(flags) == {None, *range(1, 12)}


def test_flags_by_time_do_not_depend_on_the_cut(spark, tmp_path):
    from pyspark.sql.types import _parse_datatype_string
    rng = random.Random(5)
    rows = [(i, rng.choice([None, 1, 1, 1, 2, 3, 4]), at(rng.randint(0, 40))) for i in range(80)]
    rows += rng.sample(rows, 30)
    best = {}
    for i, user, time in rows:
        if user is not None:
            best[user] = min(best.get(user, (time, i)), (time, i))
    for parts in (1, 4):
        rng.shuffle(rows)
        feed = Feed(spark, tmp_path / f"cut{parts}", _parse_datatype_string(HEAD))
        for p in range(parts):
            feed.add(rows[p::parts])
        flags, _ = flag_run(spark, feed, tmp_path, f"run{parts}", by_time=True)
        assert {i for i, f in flags.items() if f == "1"} == {i for _, i in best.values()}


def test_first_orders_by_arrival_survive_a_restart(spark, tmp_path, heads):
    heads.add([(1, 5, at(50)), (2, 5, at(40)), (3, 6, at(1))])
    assert flag_run(spark, heads, tmp_path, "arrival")[1] == {0: [(1, "0"), (2, "1"), (3, "1")]}
    heads.add([(4, 5, at(0)), (2, 5, at(40)), (5, 7, at(3))])
    flags, seen = flag_run(spark, heads, tmp_path, "arrival")
    assert seen == {1: [(2, "1"), (4, "0"), (5, "1")]}
    assert {i for i, f in flags.items() if f == "1"} == {2, 3, 5}


def test_a_batch_replayed_by_the_state_store_decides_as_before(spark, tmp_path, heads):
    heads.add([(1, 5, at(50))])
    flag_run(spark, heads, tmp_path, "replay")
    heads.add([(2, 5, at(60)), (3, 6, at(60))])
    flagged, seen = first_orders.flag(heads.stream()), []

    def write(batch, n):
        seen.append(sorted((r.id, r.if_first_order) for r in batch.collect()))
        if len(seen) == 1:
            raise ValueError("sink is down")

    def go():
        runtime.finish(runtime.start(flagged, write, str(tmp_path / "replay"), drain=True), 300)

    with pytest.raises(Exception, match="sink is down"):
        go()
    go()
    assert seen == [[(2, "0"), (3, "1")]] * 2


def test_users_share_keys_and_what_is_remembered_of_them(spark, tmp_path, heads, monkeypatch):
    """Python is called once a key and batch, not once a user; frames may end anywhere."""
    calls = str(tmp_path / "calls")

    class Counting(first_orders._FirstOrder):
        def handleInputRows(self, key, rows, timerValues):
            with open(calls, "a") as file:
                file.write("call\n")
            yield from super().handleInputRows(key, rows, timerValues)

    monkeypatch.setattr(first_orders, "_FirstOrder", Counting)
    monkeypatch.setattr(first_orders, "_SLOTS", 4, raising=False)
    rng, big = random.Random(9), 1 << 60
    rows = [(big + i, rng.randint(0, 199), at(rng.randint(0, 40))) for i in range(900)]
    rows += rng.sample(rows, 100)
    for n in range(2):
        heads.add(rows[n::2])
    before = spark.createDataFrame([(str(user),) for user in range(0, 200, 3)], "user_id string")
    best = {}
    for i, user, time in rows:
        best[user] = min(best.get(user, (time, i)), (time, i))
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(size)
    spark.conf.set(size, "7")
    try:
        flags, _ = flag_run(spark, heads, tmp_path, "keys", before, by_time=True)
    finally:
        spark.conf.set(size, usual)
    assert {i for i, f in flags.items() if f == "1"} == {i for user, (_, i) in best.items() if user % 3}
    assert set(flags) == {i for i, _, _ in rows}
    with open(calls) as file:
        assert len(file.readlines()) <= 2 * 2 * 4      # both batches are read twice


def test_orders_are_flagged_with_all_their_columns(spark, tmp_path):
    """Digits of large numbers stay beside absent ones, whether an order plays a part or not."""
    from pyspark.sql.types import _parse_datatype_string
    shape = ("id long, user_id long, create_time string, province_id long, amount decimal(18,2), "
             "malformed boolean, value string, weight double")
    big = (1 << 60) + 1
    rows = [(big, big, at(5), big, Decimal("1234567890123456.78"), None, None, 0.1),
            (big + 2, big, at(6), None, None, True, "x", None),
            (big + 4, big + 2, None, None, Decimal("0.10"), False, "", float("nan")),
            (big + 6, None, at(1), big, Decimal("-1.00"), True, "y", 1e300),
            (None, None, None, None, None, None, None, None), (None, big, at(0), big, None, None, "z", -0.5)]
    feed, seen = Feed(spark, tmp_path / "wide", _parse_datatype_string(shape)), []
    for part in (rows[::2], rows[1::2]):
        feed.add(part)
    flagged = first_orders.flag(feed.stream())
    assert flagged.schema.simpleString() == feed.spark.createDataFrame(
        [], shape + ", if_first_order string").schema.simpleString()
    runtime.finish(runtime.start(flagged, lambda batch, n: seen.extend(batch.collect()), str(tmp_path / "c"),
                                 drain=True, state_partitions=2), 300)
    first = {big, big + 4}
    assert sorted(map(repr, map(tuple, seen))) == sorted(
        repr((*row, "1" if row[0] in first else "0")) for row in rows)


def test_lonely_rows_go_out_when_their_wait_has_passed_and_are_withdrawn(spark, tmp_path, feeds):
    """Order 1 goes out alone and is met late; detail 20 meets nothing; order 4 still waits."""
    row = lambda i, t: (i, 1, None, None, at(t))
    line = lambda i, o, t: (i, o, None, 1, at(t))
    cuts = [([row(1, 0), row(2, 10)], [line(20, 9, 5), line(21, 2, 12)]),
            ([row(3, 700)], [line(31, 3, 710)]),
            ([row(4, 1500)], [line(11, 1, 8)]),
            ([row(2, 10)], [line(21, 2, 12), line(31, 3, 710)])]

    def sides(held):
        return sorted((r.side, r.order_id, r.order_detail_id or 0) for r in ledger.read(held).collect())

    def batch(orders, details):
        return pairs.side_by_side(spark.createDataFrame(orders, ORDER), spark.createDataFrame(details, DETAIL))

    held, after = store(spark, tmp_path, feeds, "cut"), []
    for n, cut in enumerate(cuts):
        for _ in range(2):      # as if the first attempt had failed just before its commit
            ledger.write(held, batch(*cut), n)
        after.append(sides(held))
    want = [("both", 1, 11), ("both", 2, 21), ("both", 3, 31), ("detail", 9, 20)]
    assert after[0] == [("both", 2, 21)]
    assert after[1] == [("both", 2, 21), ("both", 3, 31), ("detail", 9, 20), ("order", 1, 0)]
    assert after[2] == after[3] == want
    log = tables.read_slots(spark, held.table("ledger"), ledger.LEDGER)
    assert [(r.side, r.order_id) for r in log.where("gone").collect()] == [("order", 1)]
    whole = store(spark, tmp_path, feeds, "whole")
    ledger.write(whole, batch([o for c in cuts for o in c[0]], [d for c in cuts for d in c[1]]), 0)
    assert sides(whole) == want


def test_a_restarted_query_goes_on_where_it_stopped(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", schemas.DAU_INFO)
    rows = start_rows(60, 9)
    table = str(tmp_path / "dau")
    write = lambda batch, n: state.store_visits(batch, n, table)
    for part in (rows[:30], rows[30:]):
        feed.add(as_starts(spark, part).collect())
        query = run(feed.stream(), write, tmp_path)
        assert sum(p["numInputRows"] for p in query.recentProgress) == 30
    got = state.read_visits(spark, table).collect()
    assert sorted(got) == sorted(dau.first_visit(as_starts(spark, rows)).collect())


def test_the_batch_log_remembers_more_than_the_query(spark, tmp_path):
    """More batches than ``recentProgress`` holds, and a restart."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "4")
    feed = Feed(spark, tmp_path / "in", schemas.SEARCH_DOC)
    folder = str(tmp_path / "log")
    log = batch_log.BatchLog(spark, folder)
    spark.streams.addListener(log)
    try:
        rows = feed.stream().observe("docs", F.count(F.lit(1)).alias("n"), F.max("id").alias("text"))
        for parts in (8, 3):
            for _ in range(parts):
                feed.add([("1", "a"), ("2", "b")])
            query = run(rows, lambda batch, n: batch.write.mode("append").format("noop").save(), tmp_path)
            assert len(query.recentProgress) <= 4
            log.wait(query)
    finally:
        spark.streams.removeListener(log)
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    batches = batch_log.read(spark, folder).collect()
    assert sorted(b.batch for b in batches) == list(range(11)) and len({b["query"] for b in batches}) == 1
    assert {(b.rows, tuple(b.counts.items())) for b in batches} == {(2, (("docs.n", 2),))}
    assert [(t.counted, t.n) for t in batch_log.totals(spark, folder).collect()] == [("docs.n", 22)]
    (end,) = batch_log.position(spark, folder, batches[0]["query"]).values()
    assert end == {"logOffset": 10}


def test_a_failing_writer_fails_the_query(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", schemas.SEARCH_DOC)
    feed.add([("1", "a")])

    def write(batch, n):
        raise ValueError("sink is down")

    with pytest.raises(Exception, match="sink is down"):
        run(feed.stream(), write, tmp_path)
