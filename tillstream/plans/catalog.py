"""The query catalogue: every operator as a query over the test parquet, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tillstream import schemas
from tillstream.functions import codec
from tillstream.operators import dau, dims, dwd, dws, ingest, keyed, ods, ranked, search, serve
from tillstream.plans import views
from tillstream.plans.views import sql_with
from tillstream.session import run_dir, tune
from tillstream.sinks import tables as sink_tables, topics as sink_topics
from tillstream.sources.streams import TopicSpec, topic_rows
from tillstream.sources.tables import query_table, read_changed_dim, read_day, rows_as_json

Query = Callable[[SparkSession, str], DataFrame]

# Days asked for by the single-day answers; the test events and orders cover both.
DAU_DAY, DAU_DAY_BEFORE, ORDER_DAY = "2024-01-15", "2024-01-14", "1997-07-15"


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


CATALOG: dict[str, Entry] = {}


def query(sql: str | None = None, *with_views: str) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL that must give the same rows."""
    def register(run: Query) -> Query:
        def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(tune(spark), sf_dir)
        tuned.__name__, tuned.__doc__ = run.__name__, run.__doc__
        CATALOG[run.__name__] = Entry(tuned, None if sql is None else sql_with(sql, *with_views))
        return tuned
    return register


def _cents(column: str):
    return (F.col(column) * 100).cast("bigint")


# ---- log routing and daily active devices -------------------------------------------------

def _starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = ingest.route_app_log(views.app_log(spark, sf_dir))
    return dau.to_dau_info(routed.where(F.col("topic") == ingest.START))


def _visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dau.first_visit(_starts(spark, sf_dir))


@query("select topic, mid, uid, ch, ts from app_log", "app_log")
def route_app_log(spark, sf_dir):
    routed = ingest.route_app_log(views.app_log(spark, sf_dir))
    parsed = codec.parse_envelope(
        routed, "common struct<mid: string, uid: string, ch: string>, ts bigint")
    return parsed.select("topic", "common.*", "ts")


@query("select topic, mid, uid, ch, ts from app_log", "app_log")
def route_app_log_variant(spark, sf_dir):
    """The same routing on lines that are parsed once and asked by path."""
    routed = ingest.route_parsed(ingest.parse_lines(views.app_log(spark, sf_dir)))
    common = [F.variant_get("log", f"$.common.{name}", "string").alias(name) for name in ("mid", "uid", "ch")]
    return routed.select("topic", *common, F.variant_get("log", "$.ts", "bigint").alias("ts"))


_COMMON = "common: OBJECT<ar: STRING, ch: STRING, mid: STRING, uid: STRING, vc: STRING>"


@query(f"""select topic, count(*) as lines, case topic when 'START_LOG'
      then 'OBJECT<{_COMMON}, start: OBJECT<entry: STRING>, ts: BIGINT>'
      else 'OBJECT<{_COMMON}, start: STRING, ts: BIGINT>' end as shape
    from app_log group by topic""", "app_log")
def log_schema_drift(spark, sf_dir):
    """Lines and merged schema of every topic."""
    return ingest.schema_drift(ingest.route_parsed(ingest.parse_lines(views.app_log(spark, sf_dir))))


@query("select dt, count(*) as lines from app_log group by dt", "app_log")
def archive_by_day(spark, sf_dir):
    """The daily archive's line counts, by the time in the line."""
    at = F.timestamp_millis(F.get_json_object("value", "$.ts").cast("bigint"))
    lines = views.app_log(spark, sf_dir).select(F.date_format(at, "yyyy-MM-dd").alias("dt"))
    return lines.groupBy("dt").agg(F.count(F.lit(1)).alias("lines"))


@query("select * from dau", "app_log", "dau")
def dau_first_visit(spark, sf_dir):
    return _visits(spark, sf_dir)


@query("""select dt, count(*) rows_before, count(distinct mid) rows_after
    from app_log where topic = 'START_LOG' group by dt""", "app_log")
def dau_dedup_metrics(spark, sf_dir):
    return dau.dedup_metrics(_starts(spark, sf_dir)).select(
        "dt", F.col("rows_before").cast("bigint"), "rows_after")


@query(f"select count(*) total from dau where dt = '{DAU_DAY}'", "app_log", "dau")
def dau_total(spark, sf_dir):
    return serve.dau_total(_visits(spark, sf_dir), DAU_DAY)


@query("select dt, count(*) total from dau group by dt", "app_log", "dau")
def dau_total_by_day(spark, sf_dir):
    return serve.dau_total_by_day(_visits(spark, sf_dir))


@query("select dt, hr, count(*) visits from dau group by dt, hr", "app_log", "dau")
def dau_by_hour(spark, sf_dir):
    return serve.dau_hours(_visits(spark, sf_dir))


@query(f"""select hr, count(*) visits from dau where dt = '{DAU_DAY}' group by hr
    order by visits desc, hr limit 24""", "app_log", "dau")
def dau_top_hours(spark, sf_dir):
    return serve.dau_by_hour(_visits(spark, sf_dir), DAU_DAY)


@query(f"""select 'dau' id, '新增日活' as name, cast(count(*) as varchar) as value
    from dau where dt = '{DAU_DAY}'
    union all select 'new_mid', '新增设备', '233'""", "app_log", "dau")
def realtime_total(spark, sf_dir):
    return serve.realtime_total(_visits(spark, sf_dir), DAU_DAY)


@query(f"""select case when dt = '{DAU_DAY}' then 'today' else 'yesterday' end as day, hr,
      count(*) visits
    from dau where dt in ('{DAU_DAY}', '{DAU_DAY_BEFORE}') group by 1, 2""", "app_log", "dau")
def realtime_hour(spark, sf_dir):
    return serve.realtime_hour(_visits(spark, sf_dir), DAU_DAY)


@query(f"""select '[{{"id":"dau","name":"新增日活","value":"' || count(*) || '"}},'
      || '{{"id":"new_mid","name":"新增设备","value":"233"}}]' as json
    from dau where dt = '{DAU_DAY}'""", "app_log", "dau")
def realtime_total_json(spark, sf_dir):
    return serve.realtime_total_json(_visits(spark, sf_dir), DAU_DAY)


@query(f"""select '{{"yesterday":{{' || max(case when dt = '{DAU_DAY_BEFORE}' then j end)
      || '}},"today":{{' || max(case when dt = '{DAU_DAY}' then j end) || '}}}}' as json
    from (select dt, string_agg('"' || hr || '":' || n, ',' order by hr) j
      from (select dt, hr, count(*) n from dau group by dt, hr) group by dt)""", "app_log", "dau")
def realtime_hour_json(spark, sf_dir):
    return serve.realtime_hour_json(_visits(spark, sf_dir), DAU_DAY)


@query(f"""select 'dau' metric, count(*) as buckets from (select distinct dt, hr from dau
      where dt in ('{DAU_DAY}', '{DAU_DAY_BEFORE}'))
    union all select 'no_such_metric', 0""", "app_log", "dau")
def realtime_hour_unknown(spark, sf_dir):
    """Hours with visits of a known metric, and of one nobody keeps: none."""
    visits = _visits(spark, sf_dir)
    counts = [serve.realtime_hour(visits, DAU_DAY, metric).agg(
        F.lit(metric).alias("metric"), F.count(F.lit(1)).alias("buckets"))
        for metric in (serve.DAU_ID, "no_such_metric")]
    return counts[0].unionByName(counts[1])


def _stored_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of first visits, laid out by day."""
    path = run_dir(spark, "visits")
    sink_tables.append_table(_visits(spark, sf_dir), path, 0, "dt")
    return sink_tables.read_appended(spark, path, schemas.DAU_INFO)


@query(f"select count(*) total from dau where dt = '{DAU_DAY}'", "app_log", "dau")
def dau_total_stored(spark, sf_dir):
    return serve.dau_total(read_day(_stored_visits(spark, sf_dir), DAU_DAY), DAU_DAY)


@query(f"""select hr, count(*) visits from dau where dt = '{DAU_DAY}' group by hr
    order by visits desc, hr limit 24""", "app_log", "dau")
def dau_by_hour_stored(spark, sf_dir):
    return serve.dau_by_hour(read_day(_stored_visits(spark, sf_dir), DAU_DAY), DAU_DAY)


# ---- change-log fan-out -------------------------------------------------------------------

@query("""select case when o_orderkey % 2 = 0 then 'ODS_ORDER_DETAIL' else 'ODS_ORDER_INFO' end
      topic, o_orderkey * 10 + i as id, o_orderkey order_id, i sku_num
    from (select o_orderkey, o_orderstatus,
        unnest(range(1, cast(substr(o_orderpriority, 1, 1) as bigint))) i from orders)
    where o_orderstatus = 'O'""")
def ods_fanout_array(spark, sf_dir):
    sent = ods.fanout_array(views.array_change_log(spark, sf_dir))
    shape = T.StructType([T.StructField(n, T.LongType()) for n in ("id", "order_id", "sku_num")])
    return codec.parse_typed(sent, shape, keep=("topic",))


@query("""select 'ODS_ORDER_INFO' topic, o_orderkey id from orders where o_orderstatus = 'O'
    union all select 'ODS_BASE_PROVINCE', n_nationkey from nation
    union all select 'ODS_USER_INFO', c_custkey from customer
    union all select 'ODS_SKU_INFO', p_partkey from part""")
def ods_fanout_object(spark, sf_dir):
    sent = ods.fanout_object(views.object_change_log(spark, sf_dir))
    shape = T.StructType([T.StructField("id", T.LongType())])
    return codec.parse_typed(sent, shape, keep=("topic",))


# ---- order enrichment ---------------------------------------------------------------------

@query("""select id, strftime(made, '%Y-%m-%d') create_date, strftime(made, '%H') create_hour
    from order_info""", "order_info")
def order_create_parts(spark, sf_dir):
    orders = dwd.with_create_parts(views.order_head(spark, sf_dir))
    return orders.select("id", "create_date", "create_hour")


FIRST_ORDER = """select i.id, i.user_id, case when s.user_id is null and rn = 1
      then '1' else '0' end if_first_order
    from (select *, row_number() over (partition by user_id order by made, id) rn from order_info) i
    left join user_state s on s.user_id = i.user_id"""


@query(FIRST_ORDER, "order_info", "user_state")
def first_order_flag(spark, sf_dir):
    flagged = dwd.first_order_flag(views.order_head(spark, sf_dir),
                                   views.user_state(spark, sf_dir))
    return flagged.select("id", "user_id", "if_first_order")


@query("""select i.id, province_id, p.name province_name, area_code province_area_code,
      iso_3166_2 province_3166_2_code
    from order_info i left join province p on cast(p.id as bigint) = province_id""",
       "order_info", "province")
def order_with_province(spark, sf_dir):
    joined = dwd.with_province(views.order_head(spark, sf_dir, provinces=True), views.province(spark, sf_dir))
    return joined.select("id", "province_id", "province_name", "province_area_code",
                         "province_3166_2_code")


@query("""select i.id, i.user_id, gender user_gender,
      case when age < 20 then 'under 20' when age >= 60 then '60 and over'
        else cast(age // 10 * 10 as varchar) || 's' end user_age_group
    from (select i.*, u.gender, year(made) - birth_year age
      from order_info i left join user_info u on u.id = i.user_id) i""", "order_info", "user_info")
def order_with_user(spark, sf_dir):
    joined = dwd.with_user(views.order_head(spark, sf_dir), views.user_info(spark, sf_dir))
    return joined.select("id", "user_id", "user_gender", "user_age_group")


@query("""select d.id, d.sku_id, spu_id, tm_id, category3_id, spu_name, tm_name, category3_name
    from order_detail d left join sku_info s on s.id = d.sku_id""", "order_detail", "sku_info")
def detail_with_sku(spark, sf_dir):
    joined = dwd.with_sku_dims(views.order_detail(spark, sf_dir, times=False, names=False),
                               **views.product_dims(spark, sf_dir))
    return joined.select("id", "sku_id", "spu_id", "tm_id", "category3_id", "spu_name",
                         "tm_name", "category3_name")


# ---- keyed tables -------------------------------------------------------------------------

@query("""select user_id, event_id, event_type from (select *, row_number() over
      (partition by user_id order by ts desc, event_id desc) rn from events) where rn = 1""")
def latest_per_key(spark, sf_dir):
    events = views.load(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    return keyed.latest_per_key(events, ["user_id"], ["ts", "event_id"]).drop("ts")


@query("""select c_custkey id, c_name || case when moved then ' (moved)' else '' end as name,
      cast(birth_year as varchar) || '-01-01' birthday
    from (select *, c_nationkey < 10 moved, 1950 + c_custkey % 60 birth_year from customer)""")
def latest_dim_upsert(spark, sf_dir):
    """A user table in two batches, the second replacing the users who moved, read back."""
    table = run_dir(spark, "dim-user")
    users = views.user_info(spark, sf_dir)
    moved = (views.load(spark, sf_dir, "customer").where(F.col("c_nationkey") < 10)
             .select(F.col("c_custkey").alias("id")))
    changed = (users.join(moved, "id", "left_semi")
               .withColumn("name", F.concat("name", F.lit(" (moved)"))))
    sink_tables.upsert(users, table, ["id"], 0)
    sink_tables.upsert(changed, table, ["id"], 1)
    sink_tables.upsert(changed, table, ["id"], 1)  # a replay of the batch changes nothing
    stored = sink_tables.read_keyed(spark, table, schemas.USER_INFO, ["id"])
    return stored.select("id", "name", "birthday")


@query("""select cast(user_id as varchar) user_id, '1' if_consumed from (
    select user_id from user_state union select o_custkey from orders)""", "user_state")
def user_state_upsert(spark, sf_dir):
    table = run_dir(spark, "user-state")
    orders = views.load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_id"))
    sink_tables.upsert(views.user_state(spark, sf_dir), table, ["user_id"], 0)
    sink_tables.upsert(dims.user_state_rows(orders), table, ["user_id"], 1)
    return sink_tables.read_keyed(spark, table, schemas.USER_STATE, ["user_id"])


@query("""select id, name as name, area_code, iso_3166_2 from province_all
    where name <> 'NATION_0'""", "province_all")
def dim_query(spark, sf_dir):
    views.province(spark, sf_dir, every=True).createOrReplaceTempView("province_info")
    return query_table(spark, "select id, name, area_code, iso_3166_2 from province_info "
                              "where name <> 'NATION_0'")


@query("""select '{"id":"' || id || '","name":"' || name || '","area_code":"' || area_code
    || '"}' as row from province_all""", "province_all")
def dim_rows_json(spark, sf_dir):
    return rows_as_json(views.province(spark, sf_dir, every=True)
                        .select("id", "name", "area_code"))


@query("""select c_custkey id, c_name || ' v3' as name from customer""")
def dim_changes_latest(spark, sf_dir):
    """Three changes of each user in one batch of a change log, the texts in no order: through the
    fan-out and a topic into the keyed table, which keeps the last."""
    folder = run_dir(spark, "dim-changes")
    topics = TopicSpec("files", f"{folder}/topics")
    key = F.col("c_custkey").cast("string")
    versions = F.explode(F.array(F.lit(" v2"), F.lit(" v9"), F.lit(" v3"))).alias("v")
    users = views.load(spark, sf_dir, "customer").select(key.alias("id"), "c_name", versions)
    data = F.to_json(F.struct("id", F.concat("c_name", "v").alias("name")))
    log = users.select(F.concat(F.lit('{"table":"user_info","type":"update","data":'), data,
                                F.lit("}")).alias("value"))
    sink_topics.write_topics(ods.fanout_object(log), topics, 0)
    rows = dims.dim_rows(topic_rows(spark, topics, "ODS_USER_INFO"), schemas.USER_INFO)
    sink_tables.upsert(rows, f"{folder}/table", ["id"], 0, order=dims.ARRIVAL)
    return (sink_tables.read_keyed(spark, f"{folder}/table", schemas.USER_INFO, ["id"])
            .select("id", "name"))


@query("""select c_custkey id, c_name || case when c_custkey % 10 = 0 then ' v4' else ' v2' end as name
    from customer where c_custkey % 5 <> 0 or c_custkey % 10 = 0""")
def dim_with_deletes(spark, sf_dir):
    """Users inserted, changed, deleted and in part inserted again; the deletes arrive first and the
    change before them last. Through fan-out and topics into a table that knows deletes."""
    folder = run_dir(spark, "dim-deletes")
    key, users = F.col("c_custkey"), views.load(spark, sf_dir, "customer")

    def send(n: int, rows: DataFrame, kind: str, at: int, version: str) -> None:
        topics = TopicSpec("files", f"{folder}/topics-{n}")
        data = F.to_json(F.struct(key.cast("string").alias("id"), F.concat("c_name", F.lit(version)).alias("name")))
        log = rows.select(F.concat(F.lit('{"table":"user_info","type":"%s","ts":%d,"data":' % (kind, at)),
                                   data, F.lit("}")).alias("value"))
        sink_topics.write_topics(ods.fanout_object(log, changes=True), topics, 0)
        changed = dims.dim_changes(topic_rows(spark, topics, "ODS_USER_INFO"), schemas.USER_INFO)
        sink_tables.upsert(changed, f"{folder}/table", ["id"], n, order=dims.CHANGED)

    send(0, users, "insert", 100, " v1")
    send(1, users.where(key % 5 == 0), "delete", 300, " v3")
    send(2, users.where(key % 10 == 0), "insert", 400, " v4")
    send(3, users, "update", 200, " v2")
    return read_changed_dim(spark, f"{folder}/table", schemas.USER_INFO).select("id", "name")


@query("""select o_orderkey id, o_orderkey % 7 in (0, 1, 2) malformed,
      case o_orderkey % 7 when 0 then 'oops ' || o_orderkey when 1 then '{"id":' || o_orderkey
        when 2 then '{"user_id":"' || o_orderkey || '"}' end as value from orders""")
def typed_parse_rejects(spark, sf_dir):
    """Order messages, some of them no JSON, cut off, or without id: what is quarantined keeps its
    text, the rest its id."""
    key, kind = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 7
    text = (F.when(kind == 0, F.concat(F.lit("oops "), key))
             .when(kind == 1, F.concat(F.lit('{"id":'), key))
             .when(kind == 2, F.concat(F.lit('{"user_id":"'), key, F.lit('"}')))
             .otherwise(F.concat(F.lit('{"id":"'), key, F.lit('","user_id":"1"}'))))
    sent = views.load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sent"),
                                                      text.alias("value"))
    marked = codec.parse_marked(sent, schemas.ORDER_INFO, ("id",), keep=("sent",))
    return marked.select(F.coalesce("id", F.col("sent")).alias("id"), "malformed",
                         F.when(F.col("malformed"), F.col("value")).alias("value"))


# ---- wide orders --------------------------------------------------------------------------

WIDE = """select d.id order_detail_id, i.id order_id, strftime(i.made, '%Y-%m-%d') dt, order_status,
      i.user_id, sku_id, price_cents, sku_num, sku_name, final_cents, original_cents
    from order_info i join order_detail d on i.id = d.order_id"""


def _wide_columns(wide: DataFrame) -> DataFrame:
    return wide.select("order_detail_id", "order_id", "dt", "order_status", "user_id", "sku_id",
                       _cents("sku_price").alias("price_cents"), "sku_num", "sku_name",
                       _cents("final_total_amount").alias("final_cents"),
                       _cents("original_total_amount").alias("original_cents"))


def _orders_details(spark: SparkSession, sf_dir: str, times: bool = False,
                    names: bool = False) -> tuple[DataFrame, DataFrame]:
    return (dwd.with_create_parts(views.order_info(spark, sf_dir)),
            views.order_detail(spark, sf_dir, times, names))


def _wide(spark: SparkSession, sf_dir: str, names: bool = False) -> DataFrame:
    orders, details = _orders_details(spark, sf_dir, names=names)
    return dws.to_wide(dws.batch_join(orders, details), orders, details)


@query(WIDE, "order_info", "order_detail")
def order_wide_join(spark, sf_dir):
    return _wide_columns(_wide(spark, sf_dir, names=True))


HOP = " where abs(epoch_us(i.made) // 5000000 - epoch_us(d.made) // 5000000) <= 2"
WITHIN = " where abs(epoch_us(i.made) - epoch_us(d.made)) <= 600000000"


@query(WIDE + HOP, "order_info", "order_detail")
def order_wide_hop_join(spark, sf_dir):
    orders, details = _orders_details(spark, sf_dir, times=True, names=True)
    return _wide_columns(dws.to_wide(dws.hop_join(orders, details), orders, details))


@query(WIDE + WITHIN, "order_info", "order_detail")
def order_wide_interval_join(spark, sf_dir):
    orders, details = _orders_details(spark, sf_dir, times=True, names=True)
    return _wide_columns(dws.to_wide(dws.interval_join(orders, details), orders, details))


@query(WIDE, "order_info", "order_detail")
def order_wide_dedup(spark, sf_dir):
    """Details sent twice: once collapsed before the join, and the pairs once more after it."""
    orders, details = _orders_details(spark, sf_dir, names=True)
    once = dws.dedup_details(details.unionByName(details))
    return _wide_columns(dws.dedup_pairs(
        dws.to_wide(dws.batch_join(orders, once), orders, once)))


@query("""select case when i.id is null then 'detail' when d.id is null then 'order'
      else 'both' end side, i.id order_id, d.id order_detail_id, d.sku_id, i.user_id
    from (select * from order_info where order_status <> 'P') i
    full outer join order_detail d on i.id = d.order_id""", "order_info", "order_detail")
def order_full_outer(spark, sf_dir):
    """Pending orders have not arrived yet: their details stand alone."""
    orders, details = _orders_details(spark, sf_dir)
    arrived = orders.where(F.col("order_status") != "P")
    pairs = dws.full_outer_pairs(arrived, details)
    return pairs.select("side", "order_id", "order_detail_id", "sku_id", "user_id")


SHARE_ROWS = "select order_id, detail_id order_detail_id, cents from shares"


@query(SHARE_ROWS, "order_info", "order_detail", "shares")
def apportion(spark, sf_dir):
    shared = dws.apportion(_wide(spark, sf_dir))
    return shared.select("order_id", "order_detail_id",
                         _cents("final_detail_amount").alias("cents"))


@query("""select order_id, detail_id order_detail_id, -cents cents from shares""",
       "order_info", "order_detail", "shares")
def apportion_refunds(spark, sf_dir):
    """A refund is split as the payment was: its shares are the negatives to the cent."""
    wide = _wide(spark, sf_dir)
    shared = dws.apportion(wide.withColumn("final_total_amount", -F.col("final_total_amount")))
    return shared.select("order_id", "order_detail_id",
                         _cents("final_detail_amount").alias("cents"))


@query("""select '{"order_id":' || i.id || ',"order_detail_id":' || d.id || ',"order_status":"'
      || order_status || '","user_id":' || user_id || ',"sku_id":' || sku_id || ',"sku_num":'
      || sku_num || ',"sku_name":"' || sku_name || '"}' as json
    from order_info i join order_detail d on i.id = d.order_id""", "order_info", "order_detail")
def encode_wide_json(spark, sf_dir):
    wide = _wide(spark, sf_dir, names=True)
    return wide.select(codec.encode(wide, "order_id", "order_detail_id", "order_status",
                                    "user_id", "sku_id", "sku_num", "sku_name").alias("json"))


@query(f"""select cast(sum(final_cents) as bigint) cents from ({WIDE})
    where dt = '{ORDER_DAY}'""", "order_info", "order_detail")
def order_amount_total(spark, sf_dir):
    total = serve.order_amount_total(_wide(spark, sf_dir), ORDER_DAY)
    return total.select(_cents("sum_amount").alias("cents"))


@query(f"""select cast(sum(cents) as bigint) cents from shares
    where strftime(made, '%Y-%m-%d') = '{ORDER_DAY}'""", "order_info", "order_detail", "shares")
def order_amount_total_exact(spark, sf_dir):
    total = serve.order_amount_total(dws.order_amounts(_wide(spark, sf_dir)), ORDER_DAY,
                                     "final_detail_amount")
    return total.select(_cents("sum_amount").alias("cents"))


@query("""select strftime(made, '%Y-%m-%d') dt, cast(sum(final_cents) as bigint) cents,
      cast(sum(cents) as bigint) detail_cents from shares group by 1""",
       "order_info", "order_detail", "shares")
def order_amount_by_day(spark, sf_dir):
    days = serve.order_amount_by_day(dws.order_amounts(_wide(spark, sf_dir)))
    return days.select("dt", _cents("sum_amount").alias("cents"),
                       _cents("sum_detail_amount").alias("detail_cents"))


@query(f"""select hour(made) hrm, cast(sum(final_cents) as bigint) cents
    from (select i.made, i.final_cents from order_info i join order_detail d on i.id = d.order_id)
    where strftime(made, '%Y-%m-%d') = '{ORDER_DAY}' group by 1""", "order_info", "order_detail")
def order_amount_by_hour(spark, sf_dir):
    hours = serve.order_amount_by_hour(_wide(spark, sf_dir), ORDER_DAY)
    return hours.select("hrm", _cents("am").alias("cents"))


@query(f"""select hour(made) hrm, cast(sum(final_cents) as bigint) cents
    from (select i.made, i.final_cents from order_info i join order_detail d on i.id = d.order_id)
    where strftime(made, '%Y-%m-%d') = '{ORDER_DAY}' group by 1""", "order_info", "order_detail")
def order_amount_by_hour_stored(spark, sf_dir):
    """One day of the stored wide table, which lies in files by ranges of days: the test orders are
    few for their 2,400 days, a folder each would be all overhead."""
    path = run_dir(spark, "order-wide")
    by_day = _wide(spark, sf_dir).repartitionByRange("dt").sortWithinPartitions("dt")
    sink_tables.append_table(by_day, path, 0, None)
    day = read_day(sink_tables.read_appended(spark, path, schemas.ORDER_WIDE), ORDER_DAY)
    hours = serve.order_amount_by_hour(day, ORDER_DAY)
    return hours.select("hrm", _cents("am").alias("cents"))


@query("""select strftime(made, '%Y-%m-%d') dt, hour(made) hrm, cast(sum(final_cents) as bigint) cents
    from (select i.made, i.final_cents from order_info i join order_detail d on i.id = d.order_id)
    group by 1, 2""", "order_info", "order_detail")
def order_amount_by_day_hour(spark, sf_dir):
    hours = serve.order_amount_by_hour(_wide(spark, sf_dir))
    return hours.select("dt", "hrm", _cents("am").alias("cents"))


# ---- search -------------------------------------------------------------------------------

RED = "list_contains(regexp_split_to_array(lower(p_name), '[^a-z0-9]+'), 'red')"


@query(f"select p_partkey id, p_name as name from part where {RED}")
def search_match(spark, sf_dir):
    parts = views.load(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"),
                                                     F.col("p_name").alias("name"))
    return search.match(parts, "name", "red")


@query(f"""select p_partkey id, p_name as name, cast(round(p_retailprice * 100) as bigint) score
    from part where {RED} order by p_retailprice, p_partkey limit 20""")
def search_match_top(spark, sf_dir):
    parts = views.load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), "p_retailprice")
    page = search.top(search.match(parts, "name", "red"), "p_retailprice", "id", 0, 20)
    return page.select("id", "name", F.round(F.col("p_retailprice") * 100).cast("bigint")
                       .alias("score"))


_RANKED = """
    with d as (select p_partkey id, list_filter(regexp_split_to_array(lower(case when p_partkey % 3 = 0
        then p_name || ' red red' else p_name end), '[^a-z0-9]+'), lambda w: w <> '') w from part),
    s as (select count(*) docs, avg(len(w)) mean from d),
    t as (select id, len(w) as length, term, len(list_filter(w, lambda x: x = term)) n
      from d, (select unnest(['red', 'steel', 'blue']) term) where list_contains(w, term)),
    r as (select term, ln(1 + (docs - count(*) + 0.5) / (count(*) + 0.5)) idf from t, s group by term, docs)
    select id, cast(round(sum(idf * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * length / mean))) * 1000000) as bigint) score
    from t join r using (term), s group by id"""


def _part_index(spark: SparkSession, sf_dir: str) -> str:
    """Product names, a third of which have been changed by a second batch."""
    path = run_dir(spark, "search")
    parts = views.load(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_name")
    ranked.index(parts, "p_name", path, 0)
    ranked.index(parts.where(F.col("id") % 3 == 0).withColumn("p_name", F.concat("p_name", F.lit(" red red"))),
                 "p_name", path, 1)
    return path


def _score() -> Column:
    return F.round(F.col("score") * 1_000_000).cast("bigint").alias("score")


@query(_RANKED)
def search_ranked(spark, sf_dir):
    """Products by how well their names fit three words, from stored postings."""
    return ranked.search(spark, _part_index(spark, sf_dir), "Red, steel blue").select("id", _score())


@query(f"select * from ({_RANKED}) order by score desc, id limit 20")
def search_ranked_top(spark, sf_dir):
    found = ranked.search(spark, _part_index(spark, sf_dir), "red steel blue").select("id", _score())
    return search.top(found, "score", "id", descending=True)


def queries() -> dict[str, Query]:
    from tillstream.plans import streams  # noqa: F401  registers the streaming queries
    return {name: entry.run for name, entry in CATALOG.items()}


def oracle_sql() -> dict[str, str]:
    from tillstream.plans import streams  # noqa: F401
    return {name: entry.sql for name, entry in CATALOG.items() if entry.sql is not None}
