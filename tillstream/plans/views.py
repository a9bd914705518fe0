"""Logical warehouse tables over the test parquet, each in Spark and, for the check, in SQL.

The SQL twins are plain text for DuckDB; ``sql_with`` puts those a query needs in front of it.
Ids that the parquet lacks are hashes over the row's content or the name, so that no table
and no order has to be numbered in one sorted pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tillstream import schemas
from tillstream.functions import codec, money

START_EVENTS = ("view", "signup")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def name_id(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def _cents(column: str) -> Column:
    """Cents of a non-negative DOUBLE; ``round`` would go through BigDecimal for every row."""
    return F.floor(F.col(column) * 100 + 0.5)


# A line has no unique key: two polynomial hashes of 31 bits over all that tells lines apart
# make its id. Values fixed for Spark and the SQL twin alike.
_MODULUS, _FACTORS = 2147483647, (1000003, 998244353)


def _line_hash(parts: list[str], factor: int) -> str:
    text = "0"
    for part in parts:
        text = f"(({text} * {factor} + {part}) % {_MODULUS})"
    return text


def _line_id(parts: list[str]) -> str:
    high, low = (_line_hash(parts, factor) for factor in _FACTORS)
    return f"({high} * 2147483648 + {low})"


# ---- app log -----------------------------------------------------------------------------

def app_log_from(events: DataFrame) -> DataFrame:
    """Raw app-log lines: the ``start`` member in each of the forms it arrives in."""
    user = F.col("user_id").cast("string")
    common = F.to_json(F.struct(
        F.concat(F.lit("mid_"), user).alias("mid"), user.alias("uid"),
        (F.col("user_id") % 34).cast("string").alias("ar"),
        F.when(F.col("user_id") % 2 == 0, "web").otherwise("app").alias("ch"),
        F.concat(F.lit("v1."), (F.col("user_id") % 3).cast("string")).alias("vc")))
    start = (F.when(F.col("event_type").isin(*START_EVENTS), ',"start":{"entry":"icon"}')
              .when(F.col("event_type") == "error", ',"start":""')
              .when(F.col("event_type") == "click", ',"start":null').otherwise(""))
    millis = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    line = F.concat(F.lit('{"common":'), common, start, F.lit(',"ts":'), millis, F.lit("}"))
    return events.select(line.alias("value"))


def app_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return app_log_from(load(spark, sf_dir, "events"))


APP_LOG = """
select 'mid_' || user_id mid, cast(user_id as varchar) uid, cast(user_id % 34 as varchar) ar,
  case when user_id % 2 = 0 then 'web' else 'app' end ch, 'v1.' || (user_id % 3) vc,
  strftime(ts, '%Y-%m-%d') dt, strftime(ts, '%H') hr, strftime(ts, '%M') mi, epoch_us(ts) // 1000 ts,
  case when event_type in ('view', 'signup') then 'START_LOG' else 'EVENT_LOG' end topic
from events"""

DAU = """
select mid, uid, ar, ch, vc, dt, hr, mi, ts from (
  select *, row_number() over (partition by dt, mid order by ts, uid, ar, ch, vc) rn
  from app_log where topic = 'START_LOG') where rn = 1"""


# ---- orders and details ------------------------------------------------------------------

def _order_second(orders_key: Column) -> Column:
    return (orders_key * 7919) % 86400


_ORDER = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
_DETAIL = ["id", "order_id", "sku_id", "order_price", "sku_num"]


def _lines(lineitem: DataFrame) -> DataFrame:
    """Details without their time, the number of their line besides."""
    line_id = F.expr(_line_id([
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "cast(l_quantity as bigint)",
        *[f"cast(floor({c} * 100 + 0.5) as bigint)"
          for c in ("l_extendedprice", "l_discount", "l_tax")],
        "unix_seconds(cast(l_shipdate as timestamp))"]))
    price = F.call_function("div", _cents("l_extendedprice"), F.col("l_quantity").cast("bigint"))
    return lineitem.select(
        line_id.alias("id"), F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"), money.amount(price).alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"), (F.col("l_linenumber") - 1).alias("_line"))


def _named(lines: DataFrame, part: DataFrame) -> DataFrame:
    return lines.join(part.select(F.col("p_partkey").alias("sku_id"), F.col("p_name").alias("sku_name")), "sku_id")


def _line_at(day: Column) -> Column:
    line, order = F.col("_line"), F.col("order_id")
    second = _order_second(order) + line * line * 19 - (order % 3) * 4
    return F.timestamp_seconds(F.unix_seconds(day.cast("timestamp")) + second)


def detail_from(lineitem: DataFrame, orders: DataFrame | None = None,
                part: DataFrame | None = None) -> DataFrame:
    """Details. With ``orders`` they have their time, some seconds after (at times just before)
    their order's by line number; with ``part`` the product's name. A query that needs neither
    is spared the joins."""
    rows, columns = _lines(lineitem), _DETAIL
    if part is not None:
        rows, columns = _named(rows, part), [*columns, "sku_name"]
    if orders is not None:
        days = orders.select(F.col("o_orderkey").alias("order_id"), "o_orderdate")
        rows = rows.join(days, "order_id").withColumn("event_time", _line_at(F.col("o_orderdate")))
        columns = [*columns, F.date_format("event_time", codec.TIME_FORMAT).alias("create_time"),
                   "event_time"]
    return rows.select(*columns)


def sides_in_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``order_info`` (struct ``o``) and ``order_detail`` (struct ``d``, without its time as a timestamp), a row
    for each of their rows, in the sequence of the order ids. Orders are laid out among their details, so that
    the one shuffle that brings the sequence takes the place of the joins for days and totals."""
    part = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("sku_id"), F.col("p_name").alias("sku_name"))
    # A line with several products is a detail for each, but counts once for its order; one without is none.
    part = part.withColumn("_copy", F.row_number().over(Window.partitionBy("sku_id").orderBy("sku_name")))
    lines = _lines(load(spark, sf_dir, "lineitem")).join(part, "sku_id", "left")
    orders = load(spark, sf_dir, "orders")
    orders = orders.select(F.col("o_orderkey").alias("order_id"), F.struct(*_ORDER).alias("_order"))
    laid = lines.unionByName(orders, allowMissingColumns=True).where(F.col("order_id").isNotNull())
    is_order, same = F.col("_order").isNotNull(), Window.partitionBy("order_id")
    cents = F.when(F.coalesce("_copy", F.lit(1)) == 1, money.cents(F.col("order_price")) * F.col("sku_num"))
    day = F.struct("_order.o_orderdate")
    found = laid.repartitionByRange("order_id").withColumns({
        "_cents": F.sum(cents).over(same), "_days": F.collect_list(F.when(is_order, day)).over(same)})
    days = F.when(is_order, F.array(day)).otherwise(F.col("_days"))
    rows = found.where(is_order | F.col("_copy").isNotNull()).withColumn("_day", F.explode(days))
    # Orders without an id have no details.
    rows = rows.select(*_DETAIL, "sku_name", "_line", "_order", "_cents", "_day").unionByName(
        orders.where(F.col("order_id").isNull()), allowMissingColumns=True).select("*", "_order.*")
    made = F.date_format(_line_at(F.col("_day.o_orderdate")), codec.TIME_FORMAT).alias("create_time")
    total = money.amount(F.col("_cents")).alias("original_total_amount")
    return rows.select(F.when(is_order, F.struct(*_head(), total)).alias("o"),
                       F.when(~is_order, F.struct(*_DETAIL, "sku_name", made)).alias("d"))


def details_in_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``order_detail`` in the sequence of the order ids."""
    rows = sides_in_sequence(spark, sf_dir).where(F.col("d").isNotNull()).select("d.*")
    return rows.withColumn("event_time", F.to_timestamp("create_time", codec.TIME_FORMAT))


def order_detail(spark: SparkSession, sf_dir: str, times: bool = True,
                 names: bool = True) -> DataFrame:
    return detail_from(load(spark, sf_dir, "lineitem"),
                       load(spark, sf_dir, "orders") if times else None,
                       load(spark, sf_dir, "part") if names else None)


_LINE_ID_SQL = _line_id([
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "cast(l_quantity as bigint)",
    *[f"cast(floor({c} * 100 + 0.5) as bigint)"
      for c in ("l_extendedprice", "l_discount", "l_tax")],
    "(epoch_us(l_shipdate) // 1000000)"])

ORDER_DETAIL = f"""
select cast({_LINE_ID_SQL} as bigint) id,
  l_orderkey order_id, l_partkey sku_id,
  cast(round(l_extendedprice * 100) as bigint) // cast(l_quantity as bigint) price_cents,
  cast(l_quantity as bigint) sku_num, p_name sku_name,
  o_orderdate + to_seconds(cast((o_orderkey * 7919) % 86400
    + (l_linenumber - 1) * (l_linenumber - 1) * 19 - (o_orderkey % 3) * 4 as bigint)) made
from lineitem join orders on o_orderkey = l_orderkey join part on p_partkey = l_partkey"""


def _head() -> list[Column]:
    at = F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
                             + _order_second(F.col("o_orderkey")))
    return [F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("order_status"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_totalprice").cast(schemas.MONEY).alias("final_total_amount"),
            F.date_format(at, codec.TIME_FORMAT).alias("create_time"), at.alias("event_time")]


def order_head_from(orders: DataFrame, customer: DataFrame | None = None) -> DataFrame:
    """Orders without their original total, and without their province unless the customers
    are given."""
    rows = orders.select(*_head())
    if customer is None:
        return rows
    home = customer.select(F.col("c_custkey").alias("user_id"),
                           F.col("c_nationkey").cast("bigint").alias("province_id"))
    return rows.join(home, "user_id")


def order_head(spark: SparkSession, sf_dir: str, provinces: bool = False) -> DataFrame:
    return order_head_from(load(spark, sf_dir, "orders"),
                           load(spark, sf_dir, "customer") if provinces else None)


def order_totals(lineitem: DataFrame) -> DataFrame:
    """Original total of each order: the sum of price x number over its details."""
    quantity = F.col("l_quantity").cast("bigint")
    price = F.call_function("div", _cents("l_extendedprice"), quantity)
    return lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(
        F.sum(price * quantity).alias("_cents"))


def order_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = order_totals(load(spark, sf_dir, "lineitem"))
    joined = order_head(spark, sf_dir).join(totals, "id", "left")
    return joined.withColumn("original_total_amount", money.amount(F.col("_cents"))).drop("_cents")


ORDER_INFO = """
select o_orderkey id, cast(c_nationkey as bigint) province_id, o_orderstatus order_status,
  o_custkey user_id, cast(round(o_totalprice * 100) as bigint) final_cents, orig original_cents,
  o_orderdate + to_seconds(cast((o_orderkey * 7919) % 86400 as bigint)) made
from orders join customer on c_custkey = o_custkey
left join (select l_orderkey, cast(sum(cast(round(l_extendedprice * 100) as bigint)
    // cast(l_quantity as bigint) * cast(l_quantity as bigint)) as bigint) orig
  from lineitem group by l_orderkey) on l_orderkey = o_orderkey"""

SHARES = """
select *, case when seen = original_cents and detail_id = last_id
    then final_cents - given + share else share end cents from (
  select *, cast(sum(share) over (partition by order_id) as bigint) given,
    cast(sum(part) over (partition by order_id) as bigint) seen,
    max(detail_id) over (partition by order_id) last_id from (
    select i.id order_id, d.id detail_id, i.made, final_cents, original_cents,
      price_cents * sku_num part,
      (2 * final_cents * price_cents * sku_num + original_cents) // (2 * original_cents) share
    from order_info i join order_detail d on i.id = d.order_id))"""


# ---- dimensions and state ----------------------------------------------------------------

def province(spark: SparkSession, sf_dir: str, every: bool = False) -> DataFrame:
    key = F.col("n_nationkey").cast("string")
    nations = load(spark, sf_dir, "nation")
    return (nations if every else nations.where(F.col("n_nationkey") < 20)).select(
        key.alias("id"), F.col("n_name").alias("name"),
        F.lpad(key, 3, "0").alias("area_code"), F.concat(F.lit("ISO-"), key).alias("iso_code"),
        F.concat(F.lit("XX-"), key).alias("iso_3166_2"))


# Five nations have no province, so that the left join has misses.
PROVINCE_ALL = """
select cast(n_nationkey as varchar) id, n_name as name,
  lpad(cast(n_nationkey as varchar), 3, '0') area_code, 'ISO-' || n_nationkey iso_code,
  'XX-' || n_nationkey iso_3166_2 from nation"""

PROVINCE = f"{PROVINCE_ALL} where n_nationkey < 20"


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return load(spark, sf_dir, "customer").select(
        key.alias("id"), F.col("c_name").alias("name"),
        F.when(key % 2 == 0, "M").otherwise("F").alias("gender"),
        F.concat((1950 + key % 60).cast("string"), F.lit("-01-01")).alias("birthday"))


USER_INFO = """
select c_custkey id, c_name as name, case when c_custkey % 2 = 0 then 'M' else 'F' end gender,
  1950 + c_custkey % 60 birth_year from customer"""


def user_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the users have ordered before the orders at hand."""
    return load(spark, sf_dir, "customer").where(F.col("c_custkey") % 3 == 0).select(
        F.col("c_custkey").cast("string").alias("user_id"), F.lit("1").alias("if_consumed"))


USER_STATE = "select c_custkey user_id from customer where c_custkey % 3 = 0"


def product_dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    part = load(spark, sf_dir, "part")
    names = {"spus": ("p_type", "spu_name"), "trademarks": ("p_brand", "tm_name")}
    dims = {key: part.select(F.col(column).alias(name)).distinct()
                 .select(name_id(F.col(name)).alias("id"), name)
            for key, (column, name) in names.items()}
    size = F.col("p_size").cast("bigint")
    dims["categories"] = part.select(size.alias("id")).distinct().select(
        "id", F.concat(F.lit("size "), F.col("id").cast("string")).alias("name"))
    dims["skus"] = part.select(
        F.col("p_partkey").alias("id"), name_id(F.col("p_type")).alias("spu_id"),
        name_id(F.col("p_brand")).alias("tm_id"), size.alias("category3_id"))
    return dims


SKU_INFO = """
select p_partkey id, cast('0x' || substr(md5(p_type), 1, 15) as bigint) spu_id,
  cast('0x' || substr(md5(p_brand), 1, 15) as bigint) tm_id, cast(p_size as bigint) category3_id,
  p_type spu_name, p_brand tm_name, 'size ' || p_size category3_name from part"""


# ---- change logs -------------------------------------------------------------------------

def array_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array-form envelopes: per order none to four rows, by its priority digit."""
    count = F.substring("o_orderpriority", 1, 1).cast("int") - 1
    key = F.col("o_orderkey")
    numbers = F.filter(F.sequence(F.lit(0), count), lambda i: i > 0)
    rows = F.transform(numbers, lambda i: F.struct(
        (key * 10 + i).cast("string").alias("id"), key.cast("string").alias("order_id"),
        i.cast("string").alias("sku_num")))
    table = F.when(key % 2 == 0, "order_detail").otherwise("order_info")
    kind = (F.when(F.col("o_orderstatus") == "O", "INSERT")
             .when(F.col("o_orderstatus") == "F", "UPDATE").otherwise("insert"))
    return load(spark, sf_dir, "orders").select(F.to_json(F.struct(
        table.alias("table"), kind.alias("type"), rows.alias("data"))).alias("value"))


def _object_envelope(rows: DataFrame, table: str, kind: Column, **fields: Column) -> DataFrame:
    data = F.struct(*[value.cast("string").alias(name) for name, value in fields.items()])
    return rows.select(F.to_json(F.struct(F.lit(table).alias("table"), kind.alias("type"),
                                          data.alias("data"))).alias("value"))


def object_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object-form envelopes of six tables, with empty bootstrap markers in between."""
    orders, nation = load(spark, sf_dir, "orders"), load(spark, sf_dir, "nation")
    status = F.col("o_orderstatus")
    order_kind = (F.when(status == "O", "insert").when(status == "F", "update")
                   .otherwise("INSERT"))
    nation_kind = F.when(F.col("n_nationkey") % 5 == 0, "delete").otherwise("bootstrap-insert")
    marker = '{"table":"base_province","type":"bootstrap-start","data":{}}'
    logs = [
        _object_envelope(orders, "order_info", order_kind, id=F.col("o_orderkey"),
                         user_id=F.col("o_custkey"),
                         final_total_amount=F.col("o_totalprice").cast(schemas.MONEY)),
        _object_envelope(nation, "base_province", nation_kind, id=F.col("n_nationkey"),
                         name=F.col("n_name")),
        nation.select(F.lit(marker).alias("value")),
        _object_envelope(load(spark, sf_dir, "customer"), "user_info", F.lit("update"),
                         id=F.col("c_custkey"), name=F.col("c_name")),
        _object_envelope(load(spark, sf_dir, "part"), "sku_info", F.lit("bootstrap-insert"),
                         id=F.col("p_partkey")),
        _object_envelope(load(spark, sf_dir, "supplier"), "comment_info", F.lit("insert"),
                         id=F.col("s_suppkey")),
    ]
    merged = logs[0]
    for log in logs[1:]:
        merged = merged.unionByName(log)
    return merged


# ---- the SQL side ------------------------------------------------------------------------

SQL_VIEWS = {
    "app_log": APP_LOG, "dau": DAU, "order_detail": ORDER_DETAIL, "order_info": ORDER_INFO,
    "shares": SHARES, "province": PROVINCE, "province_all": PROVINCE_ALL, "user_info": USER_INFO, "user_state": USER_STATE,
    "sku_info": SKU_INFO,
}


def sql_with(query: str, *views: str) -> str:
    """The query behind the SQL views it names, in the order of ``SQL_VIEWS``."""
    if not views:
        return query.strip()
    parts = [f"{name} as ({SQL_VIEWS[name].strip()})" for name in SQL_VIEWS if name in views]
    return "with " + ",\n".join(parts) + "\n" + query.strip()
