from tillstream.operators import ingest, ods


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_start_event_and_quarantine(spark):
    sent = [('{"common":{"mid":"m1"},"start":{"entry":"icon"},"ts":1704067201000}', "START_LOG"),
            ('{"common":{"mid":"m1"},"start":null,"ts":1704067202000}', "EVENT_LOG"),
            ('{"common":{"mid":"m1"},"start":"","ts":1704067203000}', "EVENT_LOG"),
            ('{"common":{"mid":"m1"},"start":{},"ts":1704067204000}', "START_LOG"),
            ('{"common":{"mid":"m1"},"ts":1704067204000}', "EVENT_LOG"),
            ("not json", "QUARANTINE"), ("[]", "QUARANTINE")]
    routed = ingest.route_app_log(lines(spark, *[s for s, _ in sent])).collect()
    assert {(r.value, r.topic) for r in routed} == set(sent)


def fanned(spark, spread, *values):
    return sorted((r.topic, r.value) for r in spread(lines(spark, *values)).collect())


def test_array_form_keeps_inserted_fact_rows(spark):
    got = fanned(
        spark, ods.fanout_array,
        '{"table":"order_info","type":"INSERT","data":[]}',
        '{"table":"order_info","type":"INSERT","data":null}',
        '{"table":"order_info","type":"UPDATE","data":[{"id":"1"}]}',
        '{"table":"order_info","type":"insert","data":[{"id":"2"}]}',
        '{"table":"user_info","type":"INSERT","data":[{"id":"3"}]}',
        '{"table":"order_detail","type":"INSERT","data":[{"id":"4"},{"id":"5"}]}')
    assert got == [("ODS_ORDER_DETAIL", '{"id":"4"}'), ("ODS_ORDER_DETAIL", '{"id":"5"}')]


def test_object_form_passes_dimension_rows_of_any_type(spark):
    got = fanned(
        spark, ods.fanout_object,
        '{"table":"order_info","type":"bootstrap-start","data":{}}',
        '{"table":"base_province","type":"delete","data":{"id":"1","name":"n"}}',
        '{"table":"order_info","type":"insert","data":{"id":"7"}}',
        '{"table":"order_info","type":"INSERT","data":{"id":"8"}}',
        '{"table":"order_detail","type":"update","data":{"id":"9"}}',
        '{"table":"comment_info","type":"insert","data":{"id":"9"}}',
        '{"table":"spu_info","type":"bootstrap-insert","data":{"id":"2"}}')
    assert got == [("ODS_BASE_PROVINCE", '{"id":"1","name":"n"}'), ("ODS_ORDER_INFO", '{"id":"7"}'),
                   ("ODS_SPU_INFO", '{"id":"2"}')]


def test_envelopes_without_a_table_are_set_aside(spark):
    for spread in (ods.fanout_array, ods.fanout_object):
        got = fanned(spark, spread, "oops", '{"type":"INSERT","data":null}')
        assert got == [("QUARANTINE", "oops"), ("QUARANTINE", '{"type":"INSERT","data":null}')]
