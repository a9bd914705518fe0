"""Every catalogue query against its SQL twin, and the driver's contract."""

import pytest

import __spark_entry__ as contract
from tests.check import compare, connect
from tillstream.plans import catalog, streams

SQL, QUERIES = catalog.oracle_sql(), catalog.queries()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    assert name in SQL, "no SQL to compare with"
    assert compare(spark, duck, QUERIES[name], SQL[name], sf_dir) is None


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["dt", "hr", "visits"] and df.count() > 0


def test_tables_may_be_folders_of_files(spark, duck, sf_dir, tmp_path):
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    table.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    for name in ("dau_by_hour", "stream_dau"):
        assert compare(spark, duck, QUERIES[name], SQL[name], str(tmp_path)) is None


STREAMS = [n for n in sorted(QUERIES) if n.startswith("stream_") or n.endswith(("_kept", "_sessions"))]


@pytest.fixture(scope="module")
def scattered(spark, sf_dir, tmp_path_factory):
    """The test tables, those that are streamed as three files in no order."""
    folder = tmp_path_factory.mktemp("scattered")
    for table in ("events", "orders"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").repartition(3).write.parquet(
            str(folder / f"{table}.parquet"))
    for table in ("lineitem", "part", "customer"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").write.parquet(str(folder / f"{table}.parquet"))
    return str(folder)


@pytest.mark.parametrize("name, limit", [
    *[(n, {"maxFilesPerTrigger": "1"}) for n in STREAMS],
    ("stream_dau", {"maxBytesPerTrigger": "1"}), ("stream_apportion", {"maxFilesPerTrigger": "2"})])
def test_streams_do_not_depend_on_how_the_input_is_cut(spark, duck, scattered, monkeypatch, name,
                                                       limit):
    monkeypatch.setattr(streams, "TRIGGER", limit)

    def in_three_files(rows, folder):
        rows.repartition(3).write.parquet(folder)
        return streams._read(rows.sparkSession, folder, rows.schema)

    monkeypatch.setattr(streams, "_as_messages", in_three_files)
    assert compare(spark, duck, QUERIES[name], SQL[name], scattered) is None
