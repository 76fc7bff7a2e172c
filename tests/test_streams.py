"""Streaming jobs fed batch by batch. Every ``run`` is a start from the checkpoint, so each test also restarts its job."""

import datetime

import pytest
from pyspark.sql import functions as F

from helpers import rows, run, send
from tillstream.operators import dau, orders, sales, wide
from tillstream.sources.tables import read_day, read_dim, read_log
from tillstream.sources.topics import Topic, open_stream
from tillstream.streaming import jobs
from tillstream.streaming.progress import offset_ranges, read_offsets
from tillstream.streaming.runtime import dropped_late, shared_folder, stream_session
from tillstream.streaming.sinks import append_batch


@pytest.fixture
def session(spark):
    return stream_session(spark, 4)


@pytest.fixture
def root(spark):
    return shared_folder(spark, "test")


def log(mid, at, start=True):
    ms = int(datetime.datetime.fromisoformat(at).replace(tzinfo=datetime.timezone.utc).timestamp() * 1000)
    return {"common": {"mid": mid, "uid": "u" + mid, "ar": "a", "ch": "c", "vc": "v"}, "start": {} if start else None, "ts": ms}


def test_daily_active(spark, session, root):
    stream = lambda: open_stream(session, Topic("startup_log", root=f"{root}/t"))
    job = lambda: jobs.daily_active(stream(), f"{root}/dau", f"{root}/bad", "2 days")
    batches = [
        [log("1", "2024-01-01 01:00:00")] * 40 + [log("2", "2024-01-01 15:59:59")],
        [log("1", "2024-01-01 15:59:59"), log("1", "2024-01-01 16:00:00"), {"ts": 1}, "broken", None],
        [log("2", "2024-01-01 02:00:00"), log("3", "2024-01-02 02:00:00")],
    ]
    for i, batch in enumerate(batches):
        send(spark, f"{root}/t", "startup_log", batch, i * 100)
        assert dropped_late(run(job(), f"{root}/c")) == 0
    got = rows(read_log(spark, f"{root}/dau").select(F.col("dt").cast("string"), "mid", "uid", "hr", "mi"))
    assert got == [
        ("2024-01-01", "1", "u1", "9", "00"), ("2024-01-01", "2", "u2", "23", "00"),
        ("2024-01-02", "1", "u1", "0", "00"), ("2024-01-02", "3", "u3", "10", "00"),
    ]
    day = read_day(spark, f"{root}/dau", "2024-01-02", ["mid"])
    assert dau.active_total(day, "2024-01-02").first().value == 2
    assert spark.read.parquet(f"{root}/bad").count() == 3


def test_logs_and_changes_are_split(spark, session, root):
    send(spark, f"{root}/t", "app", [log("1", "2024-01-01 00:00:00"), log("1", "2024-01-01 00:00:00", start=False)])
    out = jobs.to_files(f"{root}/t")
    run(jobs.route_logs(open_stream(session, Topic("app", root=f"{root}/t")), out), f"{root}/c1")
    assert spark.read.parquet(f"{root}/t/topic=startup_log").count() == 1
    assert spark.read.parquet(f"{root}/t/topic=event_log").count() == 1
    send(spark, f"{root}/t", "db", [{"type": "INSERT", "table": "x", "data": [{"id": 1}, {"id": 2}]}, {"type": "insert", "table": "x", "data": {"id": 3}}, "{broken", None])
    run(jobs.split_changes(open_stream(session, Topic("db", root=f"{root}/t")), out, f"{root}/bad1"), f"{root}/c2")
    assert spark.read.parquet(f"{root}/bad1").count() == 2
    assert spark.read.parquet(f"{root}/t/topic=ods_x").count() == 2
    run(jobs.split_changes(open_stream(session, Topic("db", root=f"{root}/t")), out, f"{root}/bad2", any_spelling=True), f"{root}/c3")
    assert spark.read.parquet(f"{root}/t/topic=ods_x").count() == 5


def order(order_id, user, at, **more):
    return {"id": str(order_id), "user_id": str(user), "create_time": at, "province_id": "1", **more}


def order_job(spark, session, root, **more):
    provinces = session.createDataFrame([("1", "n", "a", "i")], "id string, name string, area_code string, iso_code string")
    users = session.createDataFrame([("10", "20-29", "F")], "id string, age_group string, gender string")
    return jobs.order_info(
        open_stream(session, Topic("ods_order_info", root=f"{root}/t")), lambda: provinces, lambda: users,
        f"{root}/orders", f"{root}/status", f"{root}/bad", jobs.to_files(f"{root}/t"), **more,
    )


def test_first_orders_over_batches(spark, session, root):
    known = session.createDataFrame([("12",)], "user_id string")
    batches = [
        [order(1, 10, "2024-01-02 00:00:00"), order(2, 10, "2024-01-01 00:00:00"), order(3, 12, "2024-01-01 00:00:00")],
        # user 10 again, now with an earlier order: not flagged again
        [order(4, 10, "2023-01-01 00:00:00"), order(5, 11, "2024-01-03 00:00:00"), order(6, 11, "2024-01-03 00:00:00")],
        [order(7, 11, "2024-01-04 00:00:00"), order(8, 12, "2024-01-04 00:00:00"), order(9, 13, "soon"), "broken"],
    ]
    for i, batch in enumerate(batches):
        send(spark, f"{root}/t", "ods_order_info", batch, i * 100)
        run(order_job(spark, session, root, known_users=lambda: known), f"{root}/c")
    index = read_log(spark, f"{root}/orders")
    flags = {r.id: r.if_first_order for r in index.collect()}
    assert flags == {1: "0", 2: "1", 3: "0", 4: "0", 5: "1", 6: "0", 7: "0", 8: "0"}
    one = index.where("id = 2").first()
    assert (one.province_name, one.user_age_group, one.create_hour, str(one.dt)) == ("n", "20-29", "00", "2024-01-01")
    assert rows(read_dim(spark, f"{root}/status", ["user_id"])) == [("10", "1"), ("11", "1")]
    assert spark.read.parquet(f"{root}/bad").count() == 2
    assert spark.read.parquet(f"{root}/t/topic=dwd_order_info").count() == 8


def test_first_orders_in_time_order_equal_batch(spark, session, root):
    data = [(i, 1 if i % 3 == 0 else i % 50 + 2, f"2024-01-{i // 20 + 1:02d} 00:00:{i % 20:02d}") for i in range(200)]
    for part in range(2):
        send(spark, f"{root}/t", "ods_order_info", [order(*d) for d in data[part * 100 : part * 100 + 100]])
        run(order_job(spark, session, root, by_day=False), f"{root}/c")
    batch = spark.createDataFrame(data, "id long, user_id long, create_time string")
    want = orders.flag_first_orders(batch, spark.createDataFrame([], "user_id string"))
    got = read_log(spark, f"{root}/orders")
    assert rows(got, "id", "if_first_order") == rows(want, "id", "if_first_order")


def at(minute):
    return str(datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minute))


def head(order_id, minute, **more):
    record = order(order_id, 1, at(minute), original_total_amount=30.0, final_total_amount=20.0, create_date="2024-01-01")
    return {**record, "if_first_order": "0", **more}


def line(line_id, order_id, minute, price=10.0, number=1):
    return {"id": line_id, "order_id": order_id, "sku_id": 5, "order_price": price, "sku_num": number, "create_time": at(minute)}


def test_lines_before_and_after_their_order(spark, session, root):
    def job():
        return jobs.order_pairs(
            open_stream(session, Topic("dwd_order_info", root=f"{root}/t")),
            open_stream(session, Topic("dwd_order_detail", root=f"{root}/t")), f"{root}/pairs", "10 minutes", 4,
        )

    batches = [
        ([head(1, 0)], [line(11, 1, 0), line(21, 2, 1)]),
        ([head(2, 1)], [line(12, 1, 2), line(22, 2, 1)]),
        ([], [line(11, 1, 0), line(22, 2, 1)]),  # a replay
        ([head(1, 0)] * 3, [line(12, 1, 2)] * 3),  # and another one, of the order too
        ([head(3, 60)], [line(31, 3, 60), line(91, 9, 60)]),
        ([head(4, 62)], [line(13, 1, 3), line(41, 4, 62)]),  # line 13 is an hour late
    ]
    for infos, details in batches:
        if infos:
            send(spark, f"{root}/t", "dwd_order_info", infos)
        send(spark, f"{root}/t", "dwd_order_detail", details)
        run(job(), f"{root}/c")
    pairs = spark.read.parquet(f"{root}/pairs")
    assert rows(pairs, "order_id", "order_detail_id") == [(1, 11), (1, 12), (2, 21), (2, 22), (3, 31), (4, 41)]
    assert rows(pairs.where("order_detail_id = 11"), "amount_c", "final_total_c", "dt") == [(1000, 2000, "2024-01-01")]


PAIR_SCHEMA = (
    "order_id long, order_detail_id long, amount_c long, original_total_c long, final_total_c long, order_time timestamp"
)


def allocation(spark, session, root, batches, **more):
    """Feeds pairs to the allocation operators and returns {(order, line): cents}."""
    for batch in batches:
        spark.createDataFrame(batch, PAIR_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = session.readStream.schema(PAIR_SCHEMA).parquet(f"{root}/in")
        writer = wide.with_open_sums(stream, "order_time", **more).writeStream.outputMode("update").foreachBatch(
            lambda b, i: append_batch(wide.allocate_arrivals(b), f"{root}/out", i)
        )
        run(writer, f"{root}/c")
    got = read_log(spark, f"{root}/out").collect()
    assert len(got) == sum(len(b) for b in batches)
    return {(r.order_id, r.order_detail_id): r.final_detail_c for r in got}


TIME = datetime.datetime(2024, 1, 1)


def pair(order_id, line_id, amount, original, final, time=TIME):
    return (order_id, line_id, amount, original, final, time)


def test_allocation_over_batches(spark, session, root):
    batches = [
        # order 1 in three parts, order 2 at once, order 3 never complete, order 4 of one line, order 5 without value
        [pair(1, 1, 1, 3, 100), pair(2, 1, 5, 10, 7), pair(2, 2, 5, 10, 7), pair(3, 1, 5, 10, 8), pair(4, 1, 9, 9, 4)],
        [pair(1, 2, 1, 3, 100), pair(5, 1, 0, 0, 6), pair(5, 2, 0, 0, 6)],
        [pair(1, 3, 1, 3, 100), pair(5, 3, 0, 0, 6), pair(1, 4, 0, 3, 100)],
        [pair(1, 5, 0, 3, 100)],
    ]
    got = allocation(spark, session, root, batches)
    assert got == {
        (1, 1): 33, (1, 2): 33, (1, 3): 33, (1, 4): 1, (1, 5): 0,
        (2, 1): 4, (2, 2): 3, (3, 1): 4, (4, 1): 4, (5, 1): 0, (5, 2): 6, (5, 3): 0,
    }


def test_allocation_in_line_order_equals_batch(spark, session, root):
    # order 1 holds most lines; every order's lines come in id order, over three batches
    lines = [(1 if i % 3 == 0 else i % 40 + 2, i, 100 + i * 7 % 50, 1 + i % 3) for i in range(300)]
    totals = {}
    for o, _, p, n in lines:
        totals[o] = totals.get(o, 0) + p * n
    heads = spark.createDataFrame([(o, t, t - 77) for o, t in totals.items()], "id long, original_total_c long, final_total_c long")
    details = spark.createDataFrame(lines, "order_id long, id long, order_price_c long, sku_num long")
    want = {(r.order_id, r.order_detail_id): r.final_detail_c for r in wide.allocated_pairs(heads, details).collect()}
    batches = [[pair(o, i, p * n, totals[o], totals[o] - 77) for o, i, p, n in lines[k : k + 100]] for k in (0, 100, 200)]
    assert allocation(spark, session, root, batches) == want


def test_allocation_forgets_old_orders(spark, session, root):
    hour = datetime.timedelta(hours=1)
    batches = [
        [pair(1, 1, 1, 3, 100), pair(1, 2, 1, 3, 100)],
        [pair(2, 1, 1, 1, 5, TIME + hour)],
        [pair(3, 1, 1, 1, 5, TIME + hour)],
        [pair(1, 3, 1, 3, 100)],  # an hour late: the sums are gone, the line keeps its plain share
    ]
    got = allocation(spark, session, root, batches, retention="10 minutes")
    assert got[1, 3] == 33 and got[2, 1] == got[3, 1] == 5


def test_wide_job_writes_records_and_messages(spark, session, root):
    side = wide.order_side(orders.in_cents(spark.createDataFrame(
        [(1, "1001", at(0), 7, 20.0, 0.0, 30.0, 0.0, "1", "n", "a", "g", "F", "2024-01-01")],
        "id long, order_status string, create_time string, user_id long, final_total_amount double, benefit_reduce_amount double,"
        "original_total_amount double, feight_fee double, if_first_order string, province_name string, province_area_code string,"
        "user_age_group string, user_gender string, create_date string"), orders.ORDER_MONEY))
    lines = wide.line_side(spark.createDataFrame(
        [(11, 1, 5, 1000, 1, "s", 1, 2, 3, "sp", "tm", "c"), (12, 1, 5, 1000, 2, "s", 1, 2, 3, "sp", "tm", "c")],
        "id long, order_id long, sku_id long, order_price_c long, sku_num long, sku_name string, spu_id long, tm_id long,"
        "category3_id long, spu_name string, tm_name string, category3_name string"))
    pairs = lines.join(side, "order_id").withColumn("order_time", F.to_timestamp("create_time"))
    pairs.write.parquet(f"{root}/in")
    stream = session.readStream.schema(pairs.schema).parquet(f"{root}/in")
    run(jobs.order_wide(stream, f"{root}/wide", jobs.to_files(f"{root}/t")), f"{root}/c")
    assert rows(read_log(spark, f"{root}/wide"), "order_detail_id", "final_detail_amount") == [(11, 6.67), (12, 13.33)]
    messages = open_stream(session, Topic("dws_order_wide", root=f"{root}/t"))
    run(jobs.trademark_stats(messages, "g", f"{root}/stats", f"{root}/offsets", f"{root}/bad"), f"{root}/c2")
    assert rows(read_log(spark, f"{root}/stats"), "trademark_id", "trademark_name", "amount") == [("2", "tm", 20.0)]


def test_statistics_and_offsets(spark, session, root):
    def wide_record(order_id, amount, tm=1):
        return {"order_id": order_id, "tm_id": tm, "tm_name": "a_b" if tm else None, "final_detail_amount": amount}

    def job():
        stream = open_stream(session, Topic("dws_order_wide", root=f"{root}/t"))
        return jobs.trademark_stats(stream, "g", f"{root}/stats", f"{root}/offsets", f"{root}/bad")

    send(spark, f"{root}/t", "dws_order_wide", [wide_record(1, 0.1), wide_record(2, 0.2), wide_record(3, 5.0, 0)])
    query = run(job(), f"{root}/c")
    batch_id, begin, end = offset_ranges(query)[0]
    assert batch_id == 0 and list(begin.values()) == [None] and list(end.values()) == [{"logOffset": 0}]
    send(spark, f"{root}/t", "dws_order_wide", [wide_record(4, 1.0)], 3)
    run(job(), f"{root}/c")
    stats = read_log(spark, f"{root}/stats")
    assert rows(stats, "batch_id", "trademark_id", "trademark_name", "amount") == [
        (0, "0", None, 5.0), (0, "1", "a_b", 0.3), (1, "1", "a_b", 1.0),
    ]
    assert stats.where("stat_time is null").count() == 0
    assert read_offsets(spark, f"{root}/offsets", "dws_order_wide", "g") == {0: 4}
    # a new query without the checkpoint goes on from the ledger, in the same tables
    saved = read_offsets(spark, f"{root}/offsets", "dws_order_wide", "g")
    send(spark, f"{root}/t", "dws_order_wide", [wide_record(5, 2.0), "no record", wide_record(6, "NaN")], 4)
    rest = open_stream(session, Topic("dws_order_wide", root=f"{root}/t", offsets=saved))
    run(jobs.trademark_stats(rest, "g", f"{root}/stats", f"{root}/offsets", f"{root}/bad"), f"{root}/c2")
    assert rows(read_log(spark, f"{root}/stats"), "trademark_id", "amount") == [("0", 5.0), ("1", 0.3), ("1", 1.0), ("1", 2.0)]
    assert read_offsets(spark, f"{root}/offsets", "dws_order_wide", "g") == {0: 7}
    assert len(rows(read_log(spark, f"{root}/bad"), "value")) == 2


def test_failed_batch_is_repeated_once(spark, session, root):
    """The output of a batch is written, then the job fails before the batch is committed."""
    send(spark, f"{root}/t", "x", [{"id": str(i)} for i in range(10)])

    def job(fail):
        def write(batch, batch_id):
            append_batch(batch.select("value"), f"{root}/out", batch_id)
            if fail:
                raise RuntimeError("injected")

        return open_stream(session, Topic("x", root=f"{root}/t")).writeStream.foreachBatch(write)

    with pytest.raises(Exception, match="injected"):
        run(job(True), f"{root}/c")
    assert spark.read.parquet(f"{root}/out").count() == 10
    run(job(False), f"{root}/c")
    assert spark.read.parquet(f"{root}/out").count() == 10


def test_dimensions(spark, session, root):
    def job(name, topic):
        return jobs.maintain_dimension(open_stream(session, Topic(topic, root=f"{root}/t")), name, f"{root}/{name}", f"{root}/bad/{name}")

    send(spark, f"{root}/t", "ods_base_trademark", [{"tm_id": "1", "tm_name": "a"}, {"id": "2", "tm_name": "b"}, {"tm_name": "c"}])
    run(job("base_trademark", "ods_base_trademark"), f"{root}/c1")
    send(spark, f"{root}/t", "ods_base_trademark", [{"id": "1", "tm_name": "old"}, {"id": "1", "tm_name": "new"}], 3)
    run(job("base_trademark", "ods_base_trademark"), f"{root}/c1")
    trademarks = read_dim(spark, f"{root}/base_trademark", ["id"])
    assert rows(trademarks, "id", "tm_name") == [("1", "new"), ("2", "b")]
    assert spark.read.parquet(f"{root}/bad/base_trademark").count() == 1

    send(spark, f"{root}/t", "ods_base_province", [{"id": 1, "name": "n", "area_code": "a", "iso_code": "i"}])
    run(job("province_info", "ods_base_province"), f"{root}/c2")
    assert rows(read_dim(spark, f"{root}/province_info", ["id"]), "id", "name", "area_code", "iso_code") == [("1", "n", "a", "i")]

    categories = session.createDataFrame([("3", "cat")], "id string, name string")
    spus = session.createDataFrame([("9", "spu")], "id string, spu_name string")
    dims = lambda: (categories, read_dim(session, f"{root}/base_trademark", ["id"]), spus)
    skus = [{"id": "5", "spu_id": "9", "tm_id": "1", "category3_id": "3"}, {"id": "6", "spu_id": "8", "tm_id": "7", "category3_id": "4"}]
    send(spark, f"{root}/t", "ods_sku_info", skus)
    records = open_stream(session, Topic("ods_sku_info", root=f"{root}/t"))
    run(jobs.maintain_skus(records, dims, f"{root}/sku_info", f"{root}/bad/sku"), f"{root}/c3")
    table = read_dim(spark, f"{root}/sku_info", ["id"])
    assert rows(table, "id", "category3_name", "spu_name", "tm_name") == [("5", "cat", "spu", "new"), ("6", None, None, None)]

    send(spark, f"{root}/t", "ods_order_detail", [line(1, 1, 0), {"id": 2}])
    records = open_stream(session, Topic("ods_order_detail", root=f"{root}/t"))
    job4 = jobs.order_detail(records, lambda: read_dim(session, f"{root}/sku_info", ["id"]), jobs.to_files(f"{root}/t"), f"{root}/bad/detail")
    run(job4, f"{root}/c4")
    message = spark.read.parquet(f"{root}/t/topic=dwd_order_detail").first()
    assert '"tm_name":"new"' in message.value and message.key == "1"
    assert spark.read.parquet(f"{root}/bad/detail").count() == 1


def test_sliding_windows_of_a_stream(spark, session, root):
    start = datetime.datetime(2024, 1, 1)
    data = [(start + datetime.timedelta(seconds=s), v) for s, v in [(1, 10), (4, 20), (7, 5), (12, 1)]]
    frame = spark.createDataFrame(data, "t timestamp, v long")
    end = spark.createDataFrame([(start + datetime.timedelta(hours=1), 0)], "t timestamp, v long")
    for part in (frame, end):
        part.coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = session.readStream.schema(frame.schema).parquet(f"{root}/in")
        writer = sales.sliding_sums_stream(stream, "t", "v", "1 minute").writeStream.format("parquet").option("path", f"{root}/out")
        run(writer, f"{root}/c")
    assert rows(spark.read.parquet(f"{root}/out")) == rows(sales.sliding_sums(frame, "t", "v").select("window_start", "amount", "n", "window_end"))
