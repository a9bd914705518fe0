import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tillstream import schemas, session
from tillstream.sinks import tables, topics
from tillstream.sources import streams
from tillstream.sources.tables import query_table, read_day, read_dim, rows_as_json
from tillstream.streaming import delivery, runtime

KAFKA = streams.TopicSpec("kafka", "broker:9092", {"failOnDataLoss": "false"})


def test_kafka_options():
    plain = streams.kafka_options(KAFKA, "T")
    assert plain == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "T",
                     "startingOffsets": "latest", "failOnDataLoss": "false"}
    resumed = streams.kafka_options(KAFKA, "T", "g", {0: 5, 1: 7})
    assert json.loads(resumed["startingOffsets"]) == {"T": {"0": 5, "1": 7}}
    assert resumed["kafka.group.id"] == "g"


def test_kafka_is_asked_for_by_name(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        streams.topic_stream(spark, KAFKA, "T")


def test_jdbc_options():
    got = tables.jdbc_options("jdbc:x:y", "order_wide", driver="a.B")
    assert got == {"url": "jdbc:x:y", "dbtable": "order_wide", "batchsize": "100",
                   "numPartitions": "4", "isolationLevel": "NONE", "driver": "a.B"}


def test_query_over_jdbc_pushes_the_whole_text(spark, monkeypatch):
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def load(self):
            return "rows"

    class Session:
        read = Reader()

    assert query_table(Session(), "select 1 x", {"url": "u"}) == "rows"
    assert seen == {"format": "jdbc", "url": "u", "query": "select 1 x"}
    query_table(Session(), "select id from t", {"url": "u", "partitionColumn": "id"})
    assert seen["dbtable"] == "(select id from t) q"


def test_query_table_takes_its_schema_from_the_result(spark):
    got = query_table(spark, "select 1L as id, 'x' as name")
    assert got.schema.simpleString() == "struct<id:bigint,name:string>"
    assert rows_as_json(got).first().row == '{"id":1,"name":"x"}'


def test_topic_files_go_round(spark, tmp_path):
    spec = streams.TopicSpec("files", str(tmp_path))
    rows = spark.createDataFrame([(1, "a"), (2, None)], "id long, name string")
    for _ in range(2):  # a replay replaces the batch's files
        topics.write_topics(topics.messages(rows, "A", rows["id"]), spec, 0)
    topics.write_topics(topics.messages(rows, "B"), spec, 1)
    got = []
    runtime.finish(runtime.start(streams.topic_stream(spark, spec, "A"),
                                 lambda batch, n: got.extend(batch.collect()),
                                 str(tmp_path / "checkpoint"), drain=True))
    assert sorted((r.key, r.value, r.topic) for r in got) == [
        ("1", '{"id":1,"name":"a"}', "A"), ("2", '{"id":2}', "A")]
    keys = spark.read.parquet(str(tmp_path / "topic=B")).select("key").collect()
    assert [r.key for r in keys] == [None, None]


def read_once(spark, spec, topic, checkpoint):
    got = []
    runtime.finish(runtime.start(streams.topic_stream(spark, spec, topic),
                                 lambda batch, n: got.extend(batch.collect()),
                                 str(checkpoint), drain=True, state_partitions=2))
    return sorted((r.key or "", r.value) for r in got)


def test_a_replayed_publication_is_read_once(spark, tmp_path):
    spec = streams.TopicSpec("files", str(tmp_path / "topics"), once=True)
    said = [("A", "1", "x"), ("A", "1", "x"), ("A", None, "x"), ("A", "", "x"), ("A", "2", None),
            ("B", "1", "x")]
    rows = spark.createDataFrame(said * 3, "topic string, key string, value string")
    topics.write_topics(rows.repartition(3), spec, 0, "w")
    first = read_once(spark, spec, "A", tmp_path / "checkpoint")
    # Equal messages of a batch are messages of their own; null and empty keys differ.
    assert first == sorted([(k or "", v) for t, k, v in said * 3 if t == "A"], key=str)
    topics.write_topics(rows.repartition(2, "key"), spec, 0, "w")  # the same batch in other files
    assert read_once(spark, spec, "A", tmp_path / "checkpoint") == []
    topics.write_topics(rows, spec, 1, "w")  # a further batch that says the same
    topics.write_topics(rows, spec, 0, "v")  # and another writer
    assert len(read_once(spark, spec, "A", tmp_path / "checkpoint")) == 2 * len(first)
    plain = streams.TopicSpec("files", spec.address)
    topics.write_topics(rows, plain, 2, "w")  # without identities every message is its own
    assert len(read_once(spark, spec, "A", tmp_path / "checkpoint")) == len(first)
    assert streams.topic_rows(spark, spec, "A").count() == 4 * len(first)
    assert set(streams.topic_rows(spark, spec, "A").columns) == set(
        streams.topic_rows(spark, plain, "A").columns)


def test_batches_without_equal_messages_keep_their_order(spark, tmp_path):
    rows = spark.createDataFrame([("A", "k", str(i)) for i in range(500)],
                                 "topic string, key string, value string").coalesce(1)
    sent = delivery.identified(rows, "w", 4, str(tmp_path / "kept"))
    assert [r.value for r in sent.collect()] == [str(i) for i in range(500)]
    assert sent.first().identity.startswith("w/4/") and sent.first().identity.endswith("/0")
    again = rows.unionByName(rows.where("value = '7'"))
    sent = [r.value for r in delivery.identified(again, "w", 4, str(tmp_path / "again")).collect()]
    assert sent == [str(i) for i in range(500) if i != 7] + ["7", "7"]


def test_identities_travel_as_kafka_headers(spark):
    row = spark.createDataFrame([("w/1/d/0",)], "identity string").select(delivery.headers().alias("headers"))
    own = row.selectExpr("headers", "'T' topic", "2 partition", "9L offset")
    assert own.select(delivery.from_headers()).first()[0] == "w/1/d/0"
    for none in ("cast(null as array<struct<key:string,value:binary>>)",
                 "array(named_struct('key', 'other', 'value', cast('z' as binary)))"):
        assert own.withColumn("headers", F.expr(none)).select(delivery.from_headers()).first()[0] == "T:2:9"


ROW = "id string, name string"


def test_upsert_replaces_by_key_and_may_be_replayed(spark, tmp_path):
    path, schema = str(tmp_path / "t"), schemas.SEARCH_DOC
    write = lambda rows, n, **more: tables.upsert(
        spark.createDataFrame(rows, ROW), path, ["id"], n, **more)
    write([("1", "a"), ("2", "b")], 0)
    write([("2", "c"), ("123", "d")], 1)
    write([("2", "c"), ("123", "d")], 1)
    write([], 2)
    read = lambda: sorted(tuple(r) for r in read_dim(spark, path, schema).collect())
    want = [("1", "a"), ("123", "d"), ("2", "c")]
    assert read() == want
    assert tables.compact(spark, path, schema, ["id"], 3) == 1
    assert read() == want
    write([("1", "e")], 3)
    assert read() == [("1", "e")] + want[1:]


def test_upsert_keeps_the_last_of_a_batch(spark, tmp_path):
    rows = spark.createDataFrame([("1", "old", 5), ("1", "new", 9)], ROW + ", _offset long")
    tables.upsert(rows, str(tmp_path), ["id"], 0, order=["_offset"])
    got = tables.read_keyed(spark, str(tmp_path), schemas.SEARCH_DOC, ["id"]).collect()
    assert [tuple(r) for r in got] == [("1", "new")]


def test_missing_table_reads_as_empty(spark, tmp_path):
    assert tables.read_keyed(spark, str(tmp_path / "no"), schemas.PROVINCE, ["id"]).count() == 0


def test_day_read_lists_one_day_only(spark, tmp_path):
    path, shape = str(tmp_path), "dt string, mid string"
    schema = spark.createDataFrame([], shape).schema
    for n, day in enumerate(["2024-01-01", "2024-01-02", "2024-01-02"]):
        tables.append_table(spark.createDataFrame([(day, f"m{n}")], shape), path, n)
    day = read_day(tables.read_appended(spark, path, schema), "2024-01-02")
    assert sorted(r.mid for r in day.collect()) == ["m1", "m2"]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_keyed_day_read_prunes_too(spark, tmp_path):
    rows = spark.createDataFrame([("2024-01-01", "m1"), ("2024-01-02", "m1")],
                                 "dt string, mid string")
    tables.upsert(rows, str(tmp_path), ["dt", "mid"], 0, "dt")
    table = tables.read_keyed(spark, str(tmp_path), rows.schema, ["dt", "mid"])
    day = read_day(table, "2024-01-01")
    assert day.count() == 1
    assert "PartitionFilters: [isnotnull(dt" in day._jdf.queryExecution().executedPlan().toString()


def test_preview_prints_the_first_rows(spark, capsys):
    tables.preview(spark.range(5), 2)
    shown = capsys.readouterr().out
    assert "only showing top 2 rows" in shown


def test_shared_dir_is_the_clusters(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.run_dir(spark, "x").startswith(session.shared_dir(spark))
