"""State per key: its results over micro-batches, what it forgets, and when."""

import time

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tillstream.operators import wide
from tillstream.sources.tables import read_log
from tillstream.sources.topic_store import append, open_topic
from tillstream.streaming import keyed
from tillstream.streaming.keyed import Lifetime
from tillstream.streaming.runtime import shared_folder, stream_session
from tillstream.streaming.sinks import append_batch


@pytest.fixture
def session(spark):
    return stream_session(spark, 2)


@pytest.fixture
def root(spark):
    return shared_folder(spark, "keyed")


def feed(session, root, layout, batches, operator, lateness="0 seconds", pauses=()):
    """Sends batches of rows to an operator; returns the running query's state rows after each of them.

    With ``pauses``, the seconds before each batch and after the last: a query with a lifetime by the processing time is never idle.
    """
    spark, names = session, [f.split()[0] for f in layout.split(", ")]
    append(spark.createDataFrame([], layout).select(F.lit("").alias("value")).limit(0), root, "t", 1)
    read = open_topic(session, root, "t", "earliest").select(F.from_json("value", layout).alias("r")).select("r.*")
    stream = read.withColumn("_time", F.to_timestamp("at")).withWatermark("_time", lateness)

    def write(batch, batch_id):
        append_batch(batch, f"{root}/out", batch_id)

    query = operator(stream).writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/c").trigger(processingTime="0 seconds").start()
    kept = []
    try:
        for i, batch in enumerate(batches):
            time.sleep(pauses[i] if pauses else 0)
            data = spark.createDataFrame(batch, layout).select(F.to_json(F.struct(*names)).alias("value"))
            append(data.coalesce(1), root, "t", 1)
            if not pauses:
                query.processAllAvailable()
                kept.append(sum(op.numRowsTotal for op in query.lastProgress.stateOperators[:1]))
        time.sleep(pauses[-1] if pauses else 0)
    finally:
        query.stop()
    return kept


LOG = "mid string, dt string, ts long, note string, at string"


def log(mid, second, note=None):
    return (mid, "2024-01-01", second, note, f"2024-01-01 00:{second // 60:02d}:{second % 60:02d}")


def test_a_lifetime_ends_and_is_renewed_by_writes(spark, session, root):
    """By the processing time: a key lives 10 s after its last write, not after its first."""
    batches = [[log("a", 1, "new"), log("a", 0, "first")], [log("a", 2)], [log("a", 3)], [log("a", 4, "again")]]
    feed(session, root, LOG, batches, lambda s: keyed.first_visits(s, "ts", Lifetime(10)), "1 hour", pauses=(0, 6, 6, 20, 6))
    assert rows(read_log(spark, f"{root}/out"), "mid", "ts", "note") == [("a", 0, "first"), ("a", 4, "again")]


def test_event_time_lifetime(spark, session, root):
    """By event time: 600 s after the latest write, once the watermark is beyond."""
    batches = [[log("a", 0)], [log("a", 500)], [log("b", 1000)], [log("a", 1050)], [log("b", 3000)], [log("b", 3001)], [log("a", 3002, "new")]]
    kept = feed(session, root, LOG, batches, lambda s: keyed.first_visits(s, "ts", Lifetime(600, event_time=True)))
    assert rows(read_log(spark, f"{root}/out"), "mid", "ts") == [("a", 0), ("a", 3002), ("b", 1000), ("b", 3000)]
    assert kept[-1] <= 4  # a value and a timer for each of two devices


ORDER = "user_id long, id long, create_time string, status string, at string"


def order(user, i, minute, status="x"):
    at = f"2024-01-01 00:{minute:02d}:00"
    return (user, i, at, status, at)


def test_first_orders_over_batches(spark, session, root):
    known = spark.createDataFrame([("7",), ("no number",)], "user_id string")
    batches = [
        [order(1, 10, 5), order(1, 11, 3), order(1, 9, 5, None), order(7, 12, 1)], [order(1, 13, 1), order(2, 2**61 + 1, 2)],
        [order(2, 15, 1)], [order(7, 16, 9)], [order(3, 18, 4), order(3, 17, 4)],
    ]
    kept = feed(session, root, ORDER, batches, lambda s: keyed.first_orders(s, known), "1 hour")
    got = rows(read_log(spark, f"{root}/out"), "id", "user_id", "status", "if_first_order")
    assert {r[0] for r in got if r[3] == "1"} == {11, 2**61 + 1, 17}
    assert len(got) == 10 and (9, 1, None, "0") in got
    assert kept == [2, 3, 3, 3, 4]


PAIR = "order_id long, order_detail_id long, amount_c long, original_total_c long, final_total_c long, note string, at string"


def line(order_id, i, amount, original, final, minute=0):
    return (order_id, i, amount, original, final, f"n{i}", f"2024-01-01 00:{minute:02d}:00")


def test_allocation_over_batches(spark, session, root):
    begun = spark.createDataFrame([(5, 60, 20)], "order_id long, amount_c long, shares_c long")
    batches = [
        [line(1, 3, 10, 30, 10), line(1, 4, 10, 30, 10), line(2, 1, 7, 7, 5)], [line(5, 9, 40, 100, 33)],
        [line(3, 1, 0, 0, 4), line(3, 2, 0, 0, 4)], [line(1, 1, 10, 30, 10)], [line(3, 3, 0, 0, 4)], [line(4, 1, 5, 100, 50)],
    ]
    kept = feed(session, root, PAIR, batches, lambda s: keyed.allocated(s, begun), "1 hour")
    got = {(r.order_id, r.order_detail_id): r.final_detail_c for r in read_log(spark, f"{root}/out").collect()}
    assert got == {(1, 3): 3, (1, 4): 3, (1, 1): 4, (2, 1): 5, (5, 9): 13, (3, 1): 0, (3, 2): 4, (3, 3): 0, (4, 1): 3}
    assert kept == [2, 1, 2, 1, 1, 2]  # complete orders are gone; order 3, without an amount, is remembered as done


def test_open_orders_are_forgotten(spark, session, root):
    batches = [[line(1, 1, 10, 30, 30)], [line(1, 2, 10, 30, 30, 8)], [line(9, 1, 1, 1, 1, 40)], [line(9, 2, 1, 1, 1, 41)], [line(1, 3, 10, 30, 30, 42)]]
    kept = feed(session, root, PAIR, batches, lambda s: keyed.allocated(s, None, Lifetime(600, event_time=True)))
    got = {(r.order_id, r.order_detail_id): r.final_detail_c for r in read_log(spark, f"{root}/out").collect()}
    assert got[(1, 3)] == 10 and len(got) == 5
    assert kept[1] == kept[0] and kept[3] <= kept[0]  # the second line renewed the order; at minute 40 it was gone


def test_one_sided_rows_of_the_stream_join(spark, session, root):
    orders_ = "id long, order_status string, at string"
    lines_ = "order_detail_id long, order_id long, sku_id long, at string"
    for topic in ("o", "l"):
        append(spark.range(0).select(F.lit("").alias("value")), root, topic, 1)

    def read(topic, layout, name):
        rows_ = open_topic(session, root, topic, "earliest").select("offset", F.from_json("value", layout).alias("r")).select("r.*", "offset")
        return rows_.withColumn(name, F.to_timestamp("at")).drop("at")

    orders, lines = read("o", orders_, "_order_time").drop("offset"), read("l", lines_, "_line_time")
    joined = wide.match_streams(orders, lines, "_order_time", "_line_time", "10 minutes", salts=2)

    def write(batch, batch_id):
        append_batch(batch, f"{root}/out", batch_id)

    query = joined.writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/c").trigger(processingTime="0 seconds").start()
    at = lambda m: f"2024-01-01 {m // 60:02d}:{m % 60:02d}:00"
    arrivals = [
        ([(1, "a", at(0)), (2, "b", at(1)), (1, "a", at(0))], [(11, 1, 5, at(0)), (12, 1, 6, at(2)), (31, 3, 7, at(3))]),
        ([(4, "d", at(9))], [(21, 2, 8, at(5)), (41, 4, 9, at(9)), (51, 5, 1, at(9))]),
        ([(6, "f", at(200))], [(61, 6, 1, at(200))]),
        ([(7, "g", at(400))], [(71, 8, 1, at(400))]),
        ([(7, "g", at(401))], [(72, 8, 1, at(401))]),
    ]
    try:
        for new_orders, new_lines in arrivals:
            append(spark.createDataFrame(new_orders, orders_).select(F.to_json(F.struct("*")).alias("value")), root, "o", 1)
            append(spark.createDataFrame(new_lines, lines_).select(F.to_json(F.struct("*")).alias("value")), root, "l", 1)
            query.processAllAvailable()
    finally:
        query.stop()
    got = rows(read_log(spark, f"{root}/out"), "id", "order_detail_id", "order_id", "order_status", "side")
    assert got == sorted(
        [
            (1, 11, 1, "a", "both"), (1, 12, 1, "a", "both"), (2, 21, 2, "b", "both"), (4, 41, 4, "d", "both"), (6, 61, 6, "f", "both"),
            (None, 31, 3, None, "line_only"), (None, 51, 5, None, "line_only"),
        ],
        key=lambda t: tuple((v is None, str(v)) for v in t),
    )
