import json

from helpers import rows
from tillstream.operators import routing
from tillstream.schemas import ORDER_INFO_SOURCE
from tillstream.sources.records import parse_app_log, parse_records


def texts(spark, *values):
    data = [(v if isinstance(v, str) or v is None else json.dumps(v),) for v in values]
    return spark.createDataFrame(data, "value string")


def test_logs_are_routed_by_start(spark):
    logs = texts(spark, {"start": {"entry": "icon"}, "ts": 1}, {"start": None}, {"page": {}}, "no json")
    got = [r["topic"] for r in routing.route_logs(logs).collect()]
    assert got == ["startup_log", "event_log", "event_log", "event_log"]


def test_only_upper_case_inserts_and_one_row_per_element(spark):
    changes = texts(
        spark,
        {"ts": 1, "type": "INSERT", "table": "a", "data": [{"id": "1"}, {"id": "2", "price": "1.10", "n": 1.10, "deep": {"x": [1]}}]},
        {"type": "insert", "table": "a", "data": [{"id": "3"}]},
        {"type": "UPDATE", "table": "a", "data": [{"id": "4"}]},
        {"type": "INSERT", "table": "b", "data": []},
        {"type": "INSERT", "table": "b", "data": None},
        "{broken",
    )
    got = rows(routing.split_changes(changes))
    assert [(topic, json.loads(value)) for topic, value in got] == [
        ("ods_a", {"id": "1"}), ("ods_a", {"id": "2", "price": "1.10", "n": 1.1, "deep": {"x": [1]}}),
    ]
    assert '"price":"1.10"' in got[1][1].replace(" ", "")


def test_second_tool_takes_objects_and_lower_case(spark):
    changes = texts(
        spark, {"type": "insert", "table": "a", "data": {"id": "3"}}, {"type": "INSERT", "table": "a", "data": [{"id": "4"}]}
    )
    got = rows(routing.split_changes_any(changes))
    assert [(topic, json.loads(value)) for topic, value in got] == [("ods_a", {"id": "3"}), ("ods_a", {"id": "4"})]


def test_row_changes(spark):
    row = [[("id", "1"), ("name", None)], [("id", "2"), ("name", "x")]]
    schema = "entry_type string, table string, event_type string, rows array<array<struct<name:string,value:string>>>"
    data = [
        ("TRANSACTIONBEGIN", "a", "INSERT", row), ("ROWDATA", "a", "INSERT", row), ("ROWDATA", "b", "INSERT", row[:1]),
        ("ROWDATA", "a", "DELETE", row), ("TRANSACTIONEND", "", "INSERT", row),
    ]
    entries = spark.createDataFrame(data, schema)
    flat = routing.flatten_row_changes(routing.row_data_entries(entries))
    assert [json.loads(v)["id"] for _, v in rows(flat)] == ["1", "2", "1"]
    assert {t for t, _ in rows(routing.flatten_row_changes(routing.row_data_entries(entries, "b")))} == {"b"}


def test_records_read_numbers_as_text_and_keep_bad_rows(spark):
    values = texts(
        spark,
        {"id": "12", "user_id": 7, "final_total_amount": "1.5", "order_status": 1001},
        {"id": "x", "user_id": "7"},
        {"user_id": "7"},
        "{broken",
        None,
    )
    good, bad = parse_records(values, ORDER_INFO_SOURCE, ["id", "user_id"])
    row = good.first()
    assert (row.id, row.user_id, row.final_total_amount, row.feight_fee, row.order_status, row.create_time) == (
        12, 7, 1.5, 0.0, "1001", None,
    )
    assert good.count() == 1 and bad.count() == 4
    assert "{broken" in [r["value"] for r in bad.collect()]


def test_times_are_checked(spark):
    values = texts(
        spark, {"id": 1, "create_time": "2020-01-01 00:00:00"}, {"id": 2, "create_time": "soon"}, {"id": 3}
    )
    good, bad = parse_records(values, ORDER_INFO_SOURCE, ["id"], times=("create_time",))
    assert [r.id for r in good.collect()] == [1] and bad.count() == 2


def test_app_log(spark):
    good, bad = parse_app_log(
        texts(spark, {"common": {"mid": "m", "uid": "u"}, "ts": "5", "start": {}}, {"common": {"uid": "u"}, "ts": 5}, {"ts": 1}, "x")
    )
    assert [(r.common.mid, r.common.ar, r.ts) for r in good.collect()] == [("m", None, 5)]
    assert bad.count() == 3


def test_numbers_that_are_no_numbers_are_bad(spark):
    fields = '{"id": "1", "user_id": "2", "create_time": "2020-01-01 10:00:00", "final_total_amount": %s, "original_total_amount": %s}'
    texts = [fields % x for x in (('"12,50"', '"1"'), ('"3"', '"abc"'), ('"4.5"', "null"), ('""', '"5"'), ("6", "7.25"))]
    good, bad = parse_records(spark.createDataFrame([(t,) for t in texts], "value string"), ORDER_INFO_SOURCE, ["id", "user_id"])
    assert rows(good, "final_total_amount", "original_total_amount") == [(0.0, 5.0), (4.5, 0.0), (6.0, 7.25)]
    assert rows(bad) == sorted((t,) for t in texts[:2])


def test_an_envelope_without_a_table_has_no_topic(spark):
    texts = ['{"type": "INSERT", "data": [{"id": "1"}]}', '{"type": "INSERT", "table": "t", "data": [{"id": "2"}]}']
    changes = spark.createDataFrame([(t,) for t in texts], "value string")
    assert rows(routing.split_changes(changes)) == [("ods_t", '{"id":"2"}')]
    assert rows(routing.no_envelopes(changes)) == [(texts[0],)]
