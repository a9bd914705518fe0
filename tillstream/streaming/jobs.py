"""The warehouse's jobs: source topic, operators, sink, one checkpoint each.

Every function starts one streaming query and returns it. Any subset may run, in one
application or in several; they meet only in topics and tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tillstream import schemas
from tillstream.functions import codec
from tillstream.operators import dau, dims, dwd, ingest, ods
from tillstream.operators.keyed import latest_per_key
from tillstream.sinks import tables as sink_tables, topics as sink_topics
from tillstream.sources import streams
from tillstream.sources.tables import read_dim
from tillstream.streaming import first_orders, pairs, runtime, state

DIMENSIONS: dict[str, T.StructType] = {
    "base_province": schemas.PROVINCE, "user_info": schemas.USER_INFO,
    "sku_info": schemas.SKU_INFO, "spu_info": schemas.SPU_INFO,
    "base_trademark": schemas.TRADEMARK, "base_category3": schemas.CATEGORY3,
}


@dataclass(frozen=True)
class Site:
    """Where a warehouse lives: its topics, and a folder for tables and checkpoints that all
    executors share. ``drain`` lets jobs end once they have read what is there."""
    spark: SparkSession
    topics: streams.TopicSpec
    root: str
    drain: bool = False
    state_partitions: int | None = None
    compact_every: int = 200

    def table(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    starting_offsets: dict[str, dict[int, int] | str] = field(default_factory=dict)

    def read(self, topic: str, group: str | None = None) -> DataFrame:
        """A topic, from the offsets that ``starting_offsets`` names for it if a query is new."""
        return streams.topic_stream(self.spark, self.topics, topic, group,
                                    self.starting_offsets.get(topic, "latest"))

    def run(self, job: str, stream: DataFrame, write, mode: str = "append") -> StreamingQuery:
        return runtime.start(stream, write, f"{self.root}/checkpoints/{job}", mode, self.drain,
                             job, self.state_partitions)

    def staged(self, job: str, batch: DataFrame, batch_id: int) -> DataFrame:
        return runtime.staged(batch, f"{self.root}/staging/{job}", batch_id)

    def publish(self, job: str, batch: DataFrame, batch_id: int) -> None:
        sink_topics.write_topics(batch, self.topics, batch_id, job)

    def fold(self, table: str, schema: T.StructType, keys: list[str], batch_id: int,
             partition: str | None = None, **how) -> None:
        """At the beginning of every so many batches, compact a keyed table, so that reading
        it stays cheap."""
        if self.compact_every and batch_id and batch_id % self.compact_every == 0:
            sink_tables.compact(self.spark, self.table(table), schema, keys, batch_id, partition,
                                **how)

    def typed(self, job: str, batch: DataFrame, n: int, schema: T.StructType,
              required: tuple[str, ...] = ("id",)) -> DataFrame:
        """Typed rows of a batch of messages; text that is no record, or has no id, goes to the
        quarantine topic as it came."""
        return self.sound(job, codec.parse_marked(batch, schema, required), n, schema.names)

    def sound(self, job: str, marked: DataFrame, n: int, names: list[str]) -> DataFrame:
        """The same of messages that ``codec.parse_marked`` has parsed already."""
        lost = marked.where("malformed").select(F.lit(ingest.QUARANTINE).alias("topic"),
                                                F.lit(None).cast("string").alias("key"), "value")
        self.publish(f"{job}-rejects", lost, n)
        return marked.where(~F.col("malformed")).select(*names)


# ---- app log ------------------------------------------------------------------------------

def route_logs(site: Site, folder: str, **options: str) -> StreamingQuery:
    """Raw log lines of a folder to the start, event and quarantine topics."""
    routed = ingest.route_app_log(streams.raw_log_stream(site.spark, folder, **options))
    return site.run("route_logs", routed, lambda batch, n: site.publish("route_logs", batch, n))


def archive_logs(site: Site, folder: str) -> StreamingQuery:
    """Every raw line to a folder per day received."""
    lines = streams.raw_log_stream(site.spark, folder)
    writer = sink_topics.archive_raw(lines, site.table("raw_log"))
    writer = writer.option("checkpointLocation", f"{site.root}/checkpoints/archive_logs")
    return writer.trigger(availableNow=True).start() if site.drain else writer.trigger(
        processingTime=runtime.BATCH_INTERVAL).start()


def daily_active(site: Site) -> StreamingQuery:
    """Start logs to the table of first visits, one row per day and device, however late a log
    comes. The number of logs is in the query's progress under ``before``."""
    starts = dau.to_dau_info(site.read(ingest.START, "dau_group"))
    counted = starts.observe("before", F.count(F.lit(1)).alias("rows"))

    def write(batch: DataFrame, n: int) -> None:
        site.fold("dau", schemas.DAU_INFO, state.VISIT, n, "dt", earliest=state.VISIT_ORDER)
        state.store_visits(batch, n, site.table("dau"))

    return site.run("daily_active", counted, write)


def start_log_rejects(site: Site) -> StreamingQuery:
    """Start logs without a device or a time to the quarantine topic."""
    lost = dau.rejected(site.read(ingest.START, "dau_rejects"))
    messages = lost.select(F.lit(ingest.QUARANTINE).alias("topic"),
                           F.lit(None).cast("string").alias("key"), "value")
    return site.run("start_log_rejects", messages,
                    lambda batch, n: site.publish("start_log_rejects", batch, n))


def dau_table(site: Site) -> DataFrame:
    return state.read_visits(site.spark, site.table("dau"))


# ---- change log ---------------------------------------------------------------------------

def fan_out(site: Site, topic: str, form: str = "object", changes: bool = False) -> StreamingQuery:
    """A change-log topic, in ``array`` or ``object`` form, to one ODS topic per table. ``changes``
    tells the dimension topics which rows are deleted."""
    spread = {"array": ods.fanout_array, "object": lambda m: ods.fanout_object(m, changes)}[form]
    job = f"fan_out_{form}"
    return site.run(job, spread(site.read(topic)), lambda batch, n: site.publish(job, batch, n))


def dimension(site: Site, name: str) -> StreamingQuery:
    """An ODS dimension topic to its keyed table."""
    schema = DIMENSIONS[name]
    rows = dims.dim_rows(site.read(f"ODS_{name.upper()}", f"dim_{name}_group"), schema)

    def write(batch: DataFrame, n: int) -> None:
        site.fold(name, schema, ["id"], n)
        sink_tables.upsert(batch, site.table(name), ["id"], n, order=dims.ARRIVAL)

    return site.run(f"dim_{name}", rows, write)


def dimension_changes(site: Site, name: str, keep_deleted: int = 7 * 86_400) -> StreamingQuery:
    """The same from a topic that tells deletes (``fan_out`` with ``changes``), to ``<name>_live``: a
    deleted row is gone, and stays so when older changes of it come late. Compaction drops tombstones
    ``keep_deleted`` seconds older than the youngest change."""
    schema, table = dims.changes_schema(DIMENSIONS[name]), f"{name}_live"
    rows = dims.dim_changes(site.read(f"ODS_{name.upper()}", f"dim_{name}_live_group"), DIMENSIONS[name])

    def write(batch: DataFrame, n: int) -> None:
        def keep(stored: DataFrame) -> Column:
            youngest = stored.agg(F.max(dims.CHANGED[0])).first()[0] or 0
            return ~F.col("deleted") | (F.col(dims.CHANGED[0]) >= youngest - keep_deleted)

        site.fold(table, schema, ["id"], n, latest=dims.CHANGED, keep=keep)
        sink_tables.upsert(batch, site.table(table), ["id"], n, order=dims.CHANGED)

    return site.run(f"dim_{name}_live", rows, write)


def _dim(site: Site, name: str, batch: DataFrame | None = None, key: str = "id") -> DataFrame:
    """A dimension table; with a micro-batch, only the rows its ``key`` column refers to."""
    only = None if batch is None else batch.select(F.col(key).alias("id")).distinct()
    return read_dim(site.spark, site.table(name), DIMENSIONS[name], only=only)


def order_info(site: Site) -> StreamingQuery:
    """Orders with date parts, first-order flag, province and user, to DWD_ORDER_INFO (keyed
    by order id) and the user-state table. Who has ordered is known to the stream's own state; the
    table is read when the job first starts, for users of earlier times."""
    messages = site.read("ODS_ORDER_INFO", "order_info_group").select("value")
    marked = codec.parse_marked(messages, schemas.ORDER_INFO, ("id",))
    flagged = first_orders.flag(marked, first_orders.known_users(site.spark, site.table("user_state")))

    def write(batch: DataFrame, n: int) -> None:
        site.fold("user_state", schemas.USER_STATE, ["user_id"], n, slots=state.USER_SLOTS)
        batch = site.staged("order_info_in", batch, n)
        orders = site.sound("order_info", batch, n, [*schemas.ORDER_INFO.names, "if_first_order"])
        orders = latest_per_key(orders, ["id"], ["if_first_order"])
        rich = dwd.with_user(dwd.with_province(dwd.with_create_parts(orders), _dim(site, "base_province")),
                             _dim(site, "user_info", batch, "user_id"))
        rich = site.staged("order_info_out", rich.select(*schemas.ORDER_INFO_DWD.names), n)
        site.publish("order_info", sink_topics.messages(rich, "DWD_ORDER_INFO", F.col("id")), n)
        state.remember_users(rich, n, site.table("user_state"))

    return site.run("order_info", flagged, write)


def order_detail(site: Site) -> StreamingQuery:
    """Details with their product attributes to DWD_ORDER_DETAIL."""
    details = site.read("ODS_ORDER_DETAIL", "order_detail_group").select("value")

    def write(batch: DataFrame, n: int) -> None:
        typed = site.typed("order_detail", batch, n, schemas.ORDER_DETAIL, ("id", "order_id"))
        arrived = site.staged("order_detail_in", typed, n)
        rich = dwd.with_sku_dims(arrived, _dim(site, "sku_info", arrived, "sku_id"),
                                 _dim(site, "spu_info"), _dim(site, "base_trademark"),
                                 _dim(site, "base_category3"))
        site.publish("order_detail", sink_topics.messages(rich, "DWD_ORDER_DETAIL"), n)

    return site.run("order_detail", details, write)


# ---- wide orders --------------------------------------------------------------------------

def _pair_store(site: Site) -> pairs.PairStore:
    return pairs.PairStore(site.spark, site.table("order_wide"), schemas.ORDER_INFO_DWD,
                           schemas.ORDER_DETAIL)


def order_wide(site: Site, join: str = "interval", jdbc: dict[str, str] | None = None,
               **join_options) -> StreamingQuery:
    """Orders and details to wide rows with apportioned amounts in the order_wide table, whatever
    order they arrive in, and to a database table if ``jdbc`` options are given (see
    ``sinks.tables.jdbc_options``): there an amount that changes is a further row. ``join`` is
    ``interval`` or ``hop``."""
    find = {"interval": pairs.interval_pairs, "hop": pairs.hop_pairs}[join]
    store = _pair_store(site)
    orders, details = (site.read(topic, group).select("value") for topic, group in (
        ("DWD_ORDER_INFO", "dws_order_info_group"), ("DWD_ORDER_DETAIL", "dws_order_detail_group")))

    def typed(batch: DataFrame, n: int, side: str, schema: T.StructType, keys: tuple[str, ...]) -> DataFrame:
        texts = batch.where(F.col(side).isNotNull()).select(f"{side}.value")
        return site.typed(f"order_wide_{side}", texts, n, schema, keys)

    def write(batch: DataFrame, n: int) -> None:
        batch = site.staged("order_wide_in", batch, n)
        rows = pairs.side_by_side(typed(batch, n, "o", store.orders, ("id",)),
                                  typed(batch, n, "d", store.details, ("id", "order_id")))
        found = find(store, rows, n, **join_options)
        rows = pairs.settle(store, site.staged("order_wide_found", found, n), n)
        if jdbc is not None:
            sink_tables.append_jdbc(rows, jdbc)

    return site.run("order_wide", pairs.side_by_side(orders, details), write)


def order_wide_table(site: Site) -> DataFrame:
    return pairs.settled(_pair_store(site))
