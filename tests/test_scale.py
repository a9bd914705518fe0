"""What the plans must look like, and that a hot key is split without changing the result."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tillstream import session
from tillstream.operators import dwd, dws
from tillstream.plans import catalog, views

BATCH = sorted(n for n in catalog.queries() if not n.startswith("stream_"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_batch_plans_stay_in_the_jvm_and_gather_no_group(spark, sf_dir, name):
    df = catalog.queries()[name](spark, sf_dir)
    assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString()
    plan = plan_of(df)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas",
                 "Window ", "RoundRobin"):
        assert node not in plan, f"{node} in the plan of {name}"


def test_scans_read_what_is_asked_for(spark, sf_dir):
    plan = plan_of(catalog.queries()["first_order_flag"](spark, sf_dir))
    assert "o_totalprice" not in plan and "o_orderstatus" not in plan
    plan = plan_of(catalog.queries()["apportion"](spark, sf_dir))
    assert "p_name" not in plan


def test_apportioning_shuffles_nothing_beyond_its_join(spark, sf_dir):
    """The per-order sums and their way back reuse the join's partitioning."""
    joined = catalog._wide(spark, sf_dir)
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        columns = ["order_id", "order_detail_id", "original_total_amount"]
        exchanges = [plan_of(df.select(*columns, c)).count("Exchange hash")
                     for df, c in ((joined, "final_total_amount"),
                                   (dws.apportion(joined), "final_detail_amount"))]
    # The text holds the join twice, for the details and for their sums, and nothing else.
    assert exchanges[1] <= 2 * exchanges[0]


@contextmanager
def settings(spark, values):
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture(scope="module")
def hot(spark):
    """30,000 details, a third of them of order 7; amounts of a cent to 100."""
    ids = spark.range(0, 30_000, 1, 8)
    order = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.xxhash64("id") % 500 + 1000)
    details = ids.select("id", order.cast("bigint").alias("order_id"),
                         (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10_000)) + 1).alias("_c"))
    details = details.select("id", "order_id", (F.col("_c").cast("decimal(16,0)") / 100)
                             .cast("decimal(18,2)").alias("order_price"),
                             F.lit(1).cast("bigint").alias("sku_num"),
                             F.md5(F.col("id").cast("string")).alias("sku_name"))
    orders = details.groupBy(F.col("order_id").alias("id")).agg(
        F.sum("order_price").cast("decimal(18,2)").alias("original_total_amount"))
    orders = orders.withColumn("final_total_amount", F.lit("99999.99").cast("decimal(18,2)"))
    return orders, details


def test_hot_order_is_split_and_its_cents_add_up(spark, hot):
    orders, details = hot
    with settings(spark, SKEW):
        shared = dws.apportion(dws.to_wide(dws.batch_join(orders, details), orders, details))
        rows = shared.select("order_id", "final_detail_amount", "sku_name")
        got = rows.collect()
        plan = plan_of(rows)
    assert "skew=true" in plan
    assert len(got) == 30_000
    paid = {}
    for r in got:
        paid[r.order_id] = paid.get(r.order_id, 0) + r.final_detail_amount
    assert {str(p) for p in paid.values()} == {"99999.99"}


def test_hot_province_and_null_keys_are_split(spark):
    orders = spark.range(0, 40_000, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(5)).when(F.col("id") % 3 == 1, F.col("id") % 400)
        .cast("bigint").alias("province_id"), F.md5(F.col("id").cast("string")).alias("pad"))
    provinces = spark.range(0, 400, 1, 2).select(
        F.col("id").cast("string"), F.lit("n").alias("name"), F.lit("a").alias("area_code"),
        F.lit("x").alias("iso_3166_2"))
    with settings(spark, SKEW):
        joined = dwd.with_province(orders, provinces)
        known = joined.collect()
        plan = plan_of(joined)
    assert "skew=true" in plan
    assert len(known) == 40_000
    assert sum(r.province_name is None for r in known) == sum(r.province_id is None for r in known)


def test_busy_user_reaches_no_join_with_its_orders(spark, sf_dir):
    """First-order flags: orders meet on their unique id, the user key only after reduction."""
    orders = spark.range(0, 20_000, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("user_id"),
        F.lit("2024-01-01 00:00:00").alias("create_time"))
    state = spark.createDataFrame([("4", "1")], "user_id string, if_consumed string")
    flagged = dwd.first_order_flag(orders, state)
    plan = plan_of(flagged)
    assert "partial_min(struct(create_time" in plan
    counts = {r.if_first_order: r["count"] for r in flagged.groupBy("if_first_order").count().collect()}
    users = orders.select("user_id").distinct().count()
    assert counts == {"1": users - 1, "0": 20_000 - users + 1}


def test_queries_leave_the_shuffle_width_to_the_session(spark, sf_dir):
    assert session.shuffle_width(10 << 20, 8) == 8
    assert session.shuffle_width(100 << 40, 8) == 51_200
    kept = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(kept, None)
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        plan = catalog.queries()["apportion"](spark, sf_dir)._jdf.queryExecution().executedPlan()
        assert ", 13)" in plan.toString() and spark.conf.get(kept, None) == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_stored_days_are_read_by_folder(spark, sf_dir):
    plan = plan_of(catalog.queries()["dau_total_stored"](spark, sf_dir))
    assert f"(dt#" in plan.split("PartitionFilters")[1].split("]")[0]
    plan = plan_of(catalog.queries()["order_amount_by_hour_stored"](spark, sf_dir))
    assert "EqualTo(dt" in plan


def test_details_are_unique(spark, sf_dir):
    details = views.order_detail(spark, sf_dir)
    assert details.select("id").distinct().count() == details.count()
