from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillstream import schemas
from tillstream.functions import clock, codec, money


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_quoted_and_bare_numbers_read_alike(spark):
    got = codec.parse_typed(lines(
        spark, '{"id":"7","final_total_amount":"12.50","create_time":"2024-01-01 09:05:00"}',
        '{"id":7,"final_total_amount":12.5,"create_time":"2024-01-01 09:05:00"}',
        '{"id":"x","final_total_amount":null}'), schemas.ORDER_INFO)
    rows = [(r.id, r.final_total_amount, r.create_time) for r in got.collect()]
    assert rows == [(7, Decimal("12.50"), "2024-01-01 09:05:00")] * 2 + [(None, None, None)]


@pytest.mark.parametrize("text, malformed", [
    ("not json", True), ('{"a":1', True), ("", True), (None, True), ("[1]", True), ('"x"', True),
    ("{}", False), ('{"table":"t"}', False), ('{"table":null}', False)])
def test_malformed_text_is_marked(spark, text, malformed):
    parsed = codec.parse_envelope(lines(spark, text), "table string").collect()
    assert [r.malformed for r in parsed] == [malformed]


def test_text_is_parsed_once_however_often_it_is_used(spark):
    parsed = codec.parse_envelope(lines(spark, "{}"), "table string, type string")
    used = parsed.where((F.col("table") == "a") | F.col("malformed")).select("type", "table")
    plan = used._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_encode_leaves_null_fields_out(spark):
    df = spark.createDataFrame([(1, None, "x")], "id long, name string, kind string")
    assert df.select(codec.encode(df)).first()[0] == '{"id":1,"kind":"x"}'


def test_create_parts_of_short_text_are_null(spark):
    day, hour = clock.create_parts(F.col("value"))
    got = lines(spark, "2024-01-01 09:05:00", "bad", "").select(day, hour).collect()
    assert [tuple(r) for r in got] == [("2024-01-01", "09"), ("bad", None), ("", None)]


def test_day_before_and_compact_day(spark):
    got = lines(spark, "2024-03-01").select(clock.day_before(F.col("value")),
                                            clock.compact_day(F.col("value"))).first()
    assert tuple(got) == ("2024-02-29", "20240301")
    with pytest.raises(Exception, match="CANNOT_PARSE|could not be parsed|DateTime"):
        lines(spark, "soon").select(clock.day_before(F.col("value"))).collect()


def test_proportional_is_exact_beyond_bigint(spark):
    cases = [(100, 1, 3), (100, 0, 0), (9 * 10**14, 7 * 10**14, 8 * 10**14), (1, 1, 2),
             (10**15, 10**15, 10**15), (-100, 1, 3), (-200, 1, 3), (100, -1, 3), (-1, 1, 2),
             (-9 * 10**14, 7 * 10**14, 8 * 10**14), (200, 1, 3)]
    df = spark.createDataFrame(cases, "paid long, part long, total long")
    got = df.select(money.proportional(*map(F.col, df.columns))).collect()

    def rounded(p, a, t):
        size = (2 * abs(p * a) + t) // (2 * t)
        return size if p * a >= 0 else -size

    want = [0 if t == 0 else rounded(p, a, t) for p, a, t in cases]
    assert [r[0] for r in got] == want
