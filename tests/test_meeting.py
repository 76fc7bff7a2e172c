"""Orders and lines that wait for each other in tables, and texts that are parsed once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from test_streams import head, line

from helpers import rows, run, send
from tillstream.schemas import ORDER_DETAIL
from tillstream.sources.records import parse_records
from tillstream.sources.topics import Topic, open_stream
from tillstream.streaming import jobs
from tillstream.streaming.manifests import read_published
from tillstream.streaming.runtime import shared_folder, stream_session
from tillstream.streaming.sinks import show_batch


@pytest.fixture
def session(spark):
    return stream_session(spark, 4)


@pytest.fixture
def root(spark):
    return shared_folder(spark, "meeting")


def test_a_text_is_parsed_once(spark):
    """A filter on the fields must not parse the text again for each of them."""
    texts = spark.range(3).select(F.concat(F.lit('{"id": '), "id", F.lit(', "order_id": 1}')).alias("value"))
    good, bad = parse_records(texts.union(spark.createDataFrame([(None,), ("[",)], "value string")), ORDER_DETAIL, ["id", "order_id"])
    for parsed in (good, bad):
        assert parsed._jdf.queryExecution().optimizedPlan().toString().count("from_json") <= 2  # one for each part of the union
    assert (good.count(), bad.count()) == (3, 2)


def test_what_waits_is_kept_once(spark, session, root):
    """An order waits in one row, whatever its lines, and a pair's copies are known by key and time."""
    def feed(heads, lines):
        for topic, records in (("dwd_order_info", heads), ("dwd_order_detail", lines)):
            if records:
                send(spark, f"{root}/t", topic, records)
        streams = [open_stream(session, Topic(t, root=f"{root}/t")) for t in ("dwd_order_info", "dwd_order_detail")]
        run(jobs.order_pairs(*streams, f"{root}/pairs", "10 minutes"), f"{root}/c")

    def open_rows(n, table, *columns):
        return rows(spark.read.parquet(f"{root}/pairs_open/batch_id={n}/*/{table}"), *columns)

    feed([head(1, 0), head(2, 0), head(2, 0)], [line(11, 1, 0), line(11, 1, 0), line(31, 3, 1)])
    assert open_rows(0, "orders", "_id") == [(1,), (2,)]
    feed([head(3, 1), head(5, 30)], [line(11, 1, 0), line(31, 3, 1), line(12, 1, 9), line(41, 4, 30)])
    assert open_rows(1, "orders", "_id") == [(1,), (2,), (3,), (5,)]
    assert open_rows(1, "lines", "order_detail_id", "_kind", "sku_name", "_id") == [(11, "seen", None, None), (41, "waiting", None, None)]
    feed([head(4, 31)], [line(12, 1, 9), line(51, 5, 31)])  # line 12 again, now behind the watermark
    assert open_rows(2, "orders", "_id") == [(4,), (5,)]  # those of minutes 0 and 1 are forgotten
    pairs = spark.read.parquet(f"{root}/pairs")
    assert rows(pairs, "order_id", "order_detail_id", "batch_id") == [(1, 11, 0), (1, 12, 1), (3, 31, 1), (4, 41, 2), (5, 51, 2)]


def test_a_batch_is_shown_once(spark, root):
    for n in (3, 4):  # the second is a repeated batch after a failure
        spark.range(n).write.parquet(f"{root}/written{n}")
        show_batch(spark, f"{root}/written{n}", f"{root}/log", 0, "r")
    show_batch(spark, f"{root}/nothing", f"{root}/log", 1, "r")
    assert spark.read.parquet(f"{root}/log").count() == 3


def test_rows_of_one_side_leave_once(spark, session, root):
    """Each row that stays alone comes out once, when nothing can come for it any more; the job keeps no state of its own."""
    orders, lines = "id long, order_status string, at string", "order_detail_id long, order_id long, sku_id long, at string"
    order_schema, line_schema = (spark.createDataFrame([], s).schema for s in (orders, lines))
    at = lambda m: f"2024-01-01 {m // 60:02d}:{m % 60:02d}:00"
    arrivals = [
        ([(1, "a", at(0)), (2, "b", at(1)), (1, "a", at(0))], [(11, 1, 5, at(0)), (31, 3, 7, at(3)), (31, 3, 7, at(3))]),
        ([(4, "d", at(9))], [(41, 4, 9, at(12)), (11, 1, 5, at(0)), (42, 4, 9, at(30))]),  # 42 is too far from its order
        ([(6, "f", at(200))], [(61, 6, 1, at(200))]),
        ([(7, "g", at(400))], [(71, 8, 1, at(400)), (12, 1, 5, at(1))]),  # line 12 is late
        ([(7, "g", at(401))], [(72, 8, 1, at(401))]),
    ]
    for new_orders, new_lines in arrivals:
        for topic, layout, data in (("o", orders, new_orders), ("l", lines, new_lines)):
            send(spark, f"{root}/t", topic, [r[0] for r in spark.createDataFrame(data, layout).select(F.to_json(F.struct("*"))).collect()])
        streams = [open_stream(session, Topic(t, root=f"{root}/t")) for t in ("o", "l")]
        query = run(jobs.matched_sides(*streams, order_schema, line_schema, f"{root}/matched", "10 minutes"), f"{root}/c")
        assert not any(p["stateOperators"] for p in query.recentProgress)
    layout = jobs.matched_layout(order_schema, line_schema)
    both, alone = (read_published(spark, f"{root}/matched", kind, layout) for kind in ("pairs", "alone"))
    assert rows(both, "id", "order_detail_id", "sku_id", "order_status") == [(1, 11, 5, "a"), (4, 41, 9, "d"), (6, 61, 1, "f")]
    assert rows(alone, "id", "order_detail_id", "order_id", "side") == [
        (2, None, None, "order_only"), (None, 31, 3, "line_only"), (None, 42, 4, "line_only"),
    ]
