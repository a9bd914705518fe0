"""The wired jobs from raw text to answers, over several micro-batches and restarts."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tillstream import schemas
from tillstream.operators import serve
from tillstream.sinks import tables, topics
from tillstream.sources.streams import TopicSpec
from tillstream.streaming import jobs, runtime


@pytest.fixture(params=[False])
def site(request, spark, tmp_path):
    topics = TopicSpec("files", str(tmp_path / "topics"), {"maxFilesPerTrigger": "1"}, once=request.param)
    return jobs.Site(spark, topics, str(tmp_path / "site"), drain=True, state_partitions=2)


def finish(query):
    return runtime.finish(query, 120)


def write_lines(folder, name, lines, age):
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text("\n".join(lines) + "\n")
    os.utime(path, (1_700_000_000 + age, 1_700_000_000 + age))


def publish(site, topic, rows, batch, writer="test"):
    """Messages of one batch as one topic file, younger than those of earlier batches."""
    frame = site.spark.createDataFrame([(topic, None, json.dumps(r) if isinstance(r, dict) else r)
                                        for r in rows], schemas.MESSAGE)
    topics.write_topics(frame.coalesce(1), site.topics, batch, writer)
    folder = f"{site.topics.address}/topic={topic}/part={writer}-{batch}"
    for name in os.listdir(folder):
        stamp = 1_700_000_000 + batch * 10
        os.utime(os.path.join(folder, name), (stamp, stamp))


def log(mid, ts, start='{"entry":"icon"}'):
    return '{"common":{"mid":"%s","uid":"1","ar":"3","ch":"web","vc":"v1"},"start":%s,"ts":%d}' % (
        mid, start, ts)


DAY = 1_704_067_200_000  # 2024-01-01 00:00 UTC
HOUR = 3_600_000


def test_daily_active_from_raw_lines(site, tmp_path):
    raw = tmp_path / "raw"
    write_lines(raw, "a.log", [log("m1", DAY + HOUR), log("m1", DAY + 2 * HOUR), "not json",
                               log("m2", DAY + HOUR), log("m3", DAY + HOUR, '""')], 1)
    write_lines(raw, "b.log", [log("m1", DAY + 60_000), log("m2", DAY + 25 * HOUR),
                               '{"common":{"ch":"web"},"start":{},"ts":1}'], 2)
    finish(jobs.route_logs(site, str(raw), maxFilesPerTrigger="1"))
    query = finish(jobs.daily_active(site))
    finish(jobs.start_log_rejects(site))
    finish(jobs.archive_logs(site, str(raw)))

    got = {(r.dt, r.mid, r.hr) for r in jobs.dau_table(site).collect()}
    # The earlier visit of m1 arrived in the second batch and replaced the first.
    assert got == {("2024-01-01", "m1", "00"), ("2024-01-01", "m2", "01"),
                   ("2024-01-02", "m2", "01")}
    assert serve.dau_total(jobs.dau_table(site), "2024-01-01").first().total == 2
    assert runtime.observed(query)["before"]["rows"] == 5
    lost = site.spark.read.parquet(f"{site.topics.address}/topic=QUARANTINE")
    assert {r.value for r in lost.collect()} == {
        "not json", '{"common":{"ch":"web"},"start":{},"ts":1}'}
    assert site.spark.read.text(site.table("raw_log")).count() == 8


def test_replayed_logs_change_nothing(site, tmp_path):
    raw = tmp_path / "raw"
    write_lines(raw, "a.log", [log("m1", DAY + HOUR)], 1)
    finish(jobs.route_logs(site, str(raw)))
    finish(jobs.daily_active(site))
    write_lines(raw, "b.log", [log("m1", DAY + HOUR), log("m4", DAY + HOUR)], 2)
    finish(jobs.route_logs(site, str(raw)))   # both go on from their checkpoints
    query = finish(jobs.daily_active(site))
    assert sorted(r.mid for r in jobs.dau_table(site).collect()) == ["m1", "m4"]
    assert runtime.progress(query)[0]["rows"] >= 0


def envelope(table, kind, **data):
    return {"table": table, "type": kind, "data": data}


def order(id_, user, time, paid, total, province="1"):
    return envelope("order_info", "insert", id=str(id_), user_id=str(user), province_id=province,
                    order_status="1", final_total_amount=paid, original_total_amount=total,
                    create_time=time)


def detail(id_, order_id, time, price, num):
    return envelope("order_detail", "insert", id=str(id_), order_id=str(order_id), sku_id="7",
                    order_price=price, sku_num=str(num), sku_name="thing", create_time=time)


@pytest.mark.parametrize("site", [False, True], indirect=True)
def test_orders_from_change_log_to_amounts(site):
    first = [envelope("base_province", "bootstrap-insert", id="1", name="Old", area_code="11",
                      iso_code="ISO-1", iso_3166_2="XX-1"),
             envelope("user_info", "update", id="9", name="n", gender="F", birthday="1994-05-01"),
             envelope("sku_info", "insert", id="7", spu_id="3", tm_id="4", category3_id="5"),
             envelope("base_trademark", "insert", id="4", tm_name="brand"),
             envelope("base_province", "bootstrap-start"),
             order(1, 9, "2024-01-01 10:00:00", "100.00", "90.00"),
             detail(11, 1, "2024-01-01 10:00:01", "30.00", 1),
             detail(12, 1, "2024-01-01 10:00:02", "10.00", 3)]
    second = [envelope("base_province", "update", id="1", name="New", area_code="11",
                       iso_code="ISO-1", iso_3166_2="XX-1"),
              order(2, 9, "2024-01-01 10:01:00", "5.00", "5.00"),
              order(3, 8, "2024-01-01 11:30:00", "7.00", "8.00", province="77"),
              detail(13, 1, "2024-01-01 10:00:03", "30.00", 1),
              detail(21, 2, "2024-01-01 10:01:00", "5.00", 1),
              detail(31, 3, "2024-01-01 11:20:00", "4.00", 2),
              detail(11, 1, "2024-01-01 10:00:01", "30.00", 1)]    # sent again
    for batch, rows in enumerate([first, second]):
        publish(site, "CHANGES", rows, batch)
        finish(jobs.fan_out(site, "CHANGES"))
        for name in ("base_province", "user_info", "sku_info", "base_trademark"):
            finish(jobs.dimension(site, name))
        finish(jobs.order_info(site))
        finish(jobs.order_detail(site))
        finish(jobs.order_wide(site))

    rows = {r.order_detail_id: r for r in jobs.order_wide_table(site).collect()}
    assert sorted(rows) == [11, 12, 13, 21, 31]
    # 100 paid over 90: the third detail, in the second batch, completes the order.
    assert [str(rows[i].final_detail_amount) for i in (11, 12, 13)] == ["33.33", "33.33", "33.34"]
    assert str(rows[21].final_detail_amount) == "5.00" and str(rows[31].final_detail_amount) == "7.00"
    assert [rows[i].if_first_order for i in (11, 21, 31)] == ["1", "0", "1"]
    assert rows[11].province_name == "Old" and rows[21].province_name == "New"
    assert rows[31].province_name is None
    assert (rows[11].user_gender, rows[11].user_age_group) == ("F", "30s")
    assert (rows[11].tm_name, rows[11].spu_id, rows[11].spu_name) == ("brand", 3, None)
    wide = jobs.order_wide_table(site)
    exact = serve.order_amount_total(wide, "2024-01-01", "final_detail_amount").first()
    assert str(exact.sum_amount) == "112.00"
    assert str(serve.order_amount_total(wide, "2024-01-01").first().sum_amount) == "312.00"
    hours = {r.hrm: str(r.am) for r in serve.order_amount_by_hour(wide, "2024-01-01").collect()}
    assert hours == {10: "305.00", 11: "7.00"}


def test_typed_text_that_is_no_record_is_quarantined(site):
    good = {"id": "1", "user_id": "9", "create_time": "2024-01-01 10:00:00"}
    bad = ["oops", '{"id":"2"', {"user_id": "5"}]
    publish(site, "ODS_ORDER_INFO", [good, *bad], 0)
    publish(site, "ODS_ORDER_DETAIL", [{"id": "7", "order_id": "1"}, {"id": "8"}, "[]x"], 0)
    finish(jobs.order_info(site))
    finish(jobs.order_detail(site))
    read = lambda topic: site.spark.read.parquet(f"{site.topics.address}/topic={topic}")
    assert [json.loads(r.value)["id"] for r in read("DWD_ORDER_INFO").collect()] == [1]
    assert [json.loads(r.value)["id"] for r in read("DWD_ORDER_DETAIL").collect()] == [7]
    lost = {r.value for r in read("QUARANTINE").collect()}
    assert lost == {"oops", '{"id":"2"', json.dumps({"user_id": "5"}), json.dumps({"id": "8"}), "[]x"}


def test_the_last_change_of_a_dimension_row_wins(site):
    rows = [envelope("base_province", "update", id="1", name=n) for n in ("Zeta", "Alpha")]
    publish(site, "CHANGES", rows, 0)
    finish(jobs.fan_out(site, "CHANGES"))
    finish(jobs.dimension(site, "base_province"))
    stored = tables.read_keyed(site.spark, site.table("base_province"), schemas.PROVINCE, ["id"])
    assert [r.name for r in stored.collect()] == ["Alpha"]
    keys = site.spark.read.parquet(f"{site.topics.address}/topic=ODS_BASE_PROVINCE")
    assert {r.key for r in keys.collect()} == {"1"}


def test_changes_from_several_partitions_are_ordered_by_time(spark):
    from tillstream.operators import dims
    sent = [("1", '{"id":"1","name":"first"}', 0, 900, "2024-01-01 00:00:01"),
            ("1", '{"id":"1","name":"last"}', 1, 5, "2024-01-01 00:00:02")]
    messages = spark.createDataFrame(sent, "key string, value string, partition int, offset long, "
                                           "at string").withColumn("timestamp", F.to_timestamp("at"))
    from tillstream.operators.keyed import latest_per_key
    rows = latest_per_key(dims.dim_rows(messages, schemas.PROVINCE), ["id"], dims.ARRIVAL)
    assert [r.name for r in rows.collect()] == ["last"]


def test_jobs_start_at_given_offsets(site, monkeypatch):
    from dataclasses import replace
    asked = {}
    monkeypatch.setattr(jobs.streams, "topic_stream",
                        lambda spark, spec, topic, group, start: asked.update({topic: start}))
    at = replace(site, starting_offsets={"CHANGES": {0: 12, 1: 7}})
    at.read("CHANGES")
    at.read("OTHER")
    assert asked == {"CHANGES": {0: 12, 1: 7}, "OTHER": "latest"}


def test_user_table_tells_a_new_job_who_has_ordered(site, spark):
    """Users of the table are no first buyers; folding the table keeps two generations."""
    from tillstream.streaming import first_orders, state
    table = site.table("user_state")
    old = spark.createDataFrame([(1, 5, "1")], "id long, user_id long, if_first_order string")
    for n in range(3):
        state.remember_users(old, n, table)
    for generation in (1, 2, 3):
        assert tables.compact(spark, table, schemas.USER_STATE, ["user_id"], 4,
                              slots=state.USER_SLOTS) == generation
        assert [r.user_id for r in first_orders.known_users(spark, table).collect()] == ["5"]
    assert sorted(os.listdir(table)) == ["gen=2", "gen=3"]
    sent = [{"id": str(i), "user_id": u, "create_time": "2024-01-01 10:00:00"} for i, u in ((7, "5"), (8, "6"))]
    publish(site, "ODS_ORDER_INFO", sent, 0)
    finish(jobs.order_info(site))
    rows = [json.loads(r.value) for r in
            spark.read.parquet(f"{site.topics.address}/topic=DWD_ORDER_INFO").collect()]
    assert {r["id"]: r["if_first_order"] for r in rows} == {7: "0", 8: "1"}
    assert {r.user_id for r in first_orders.known_users(spark, table).collect()} == {"5", "6"}


def test_deleted_dimension_rows_stay_deleted(spark, tmp_path):
    """A delete outlives an older change that comes in a later batch, also after compaction; a younger
    insert brings the row back, and old tombstones go."""
    from tillstream.operators import dims
    from tillstream.sources.tables import read_changed_dim
    table, schema = str(tmp_path / "live"), dims.changes_schema(schemas.CATEGORY3)

    def change(n, *rows):
        tables.upsert(spark.createDataFrame(rows, schema), table, ["id"], n, order=dims.CHANGED)

    def live():
        return sorted(tuple(r) for r in read_changed_dim(spark, table, schemas.CATEGORY3).collect())

    change(0, (1, "a", 100, 1, False), (2, "b", 100, 2, False), (3, "c", 100, 3, False))
    change(1, (1, "a", 300, 4, True), (2, "b", 300, 5, True), (2, "b", 300, 4, False))
    change(2, (1, "late", 200, 6, False), (2, "back", 400, 7, False))
    assert live() == [(2, "back"), (3, "c")]
    tables.compact(spark, table, schema, ["id"], 3, latest=dims.CHANGED)
    change(3, (1, "later still", 250, 8, False))
    assert live() == [(2, "back"), (3, "c")]
    tables.compact(spark, table, schema, ["id"], 4, latest=dims.CHANGED,
                   keep=lambda rows: ~F.col("deleted") | (F.col("changed_at") >= 1000))
    assert live() == [(2, "back"), (3, "c")]


def test_kept_hours_survive_replays_and_late_visits(spark, tmp_path):
    from tillstream.streaming import kept
    shape = "mid string, dt string, hr string, ts long, uid string, ar string, ch string, vc string, mi string"
    row = lambda mid, hr, dt="2024-01-01": (mid, dt, f"{hr:02d}", hr, "u", "a", "c", "v", "00")
    batches = [[row("a", 9), row("b", 9), row("b", 10), row("c", 3, "2024-01-02")], [row("a", 7), row("b", 11)],
               [row("a", 7), row("d", 9)], [row("a", 1, "2024-01-02")]]
    root = str(tmp_path / "kept")
    for n, rows in enumerate(batches):
        for _ in range(2):
            kept.keep_hours(spark.createDataFrame(rows, shape), n, root)
    assert sorted(tuple(r) for r in kept.hours(spark, root).collect()) == [
        ("2024-01-01", "07", 1), ("2024-01-01", "09", 2), ("2024-01-02", "01", 1), ("2024-01-02", "03", 1)]
    day = kept.hours(spark, root, ["2024-01-02"])
    assert day.count() == 2 and all("dt=2024-01-02" in f for f in day.inputFiles())
    import os
    written = [d for d in os.listdir(f"{root}/hours") if os.path.isdir(f"{root}/hours/{d}/batch=3")]
    assert written == ["dt=2024-01-02"]  # a batch writes only days that it changed
