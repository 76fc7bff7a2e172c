"""Registered queries that run jobs over topics with true offsets, in several micro-batches, with stops and starts between them.

Records arrive in order of their time, in parts, so that watermarks move and state is let go on the way. Results are whole rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions.money import from_cents, to_cents
from tillstream.operators import lookups, orders
from tillstream.plans import flows
from tillstream.plans.catalog import query
from tillstream.plans.parts import parts_of
from tillstream.schemas import DAU_INFO, DWS_ORDER_WIDE, ODS_PREFIX, STARTUP_LOG
from tillstream.sources import shop
from tillstream.sources.records import json_field
from tillstream.sources.tables import read_days, read_log
from tillstream.sources.topic_store import append, open_topic
from tillstream.streaming import jobs, manifests, sharded, snapshots
from tillstream.streaming.progress import RangeLedger, checkpoint_path, read_ranges
from tillstream.streaming.runtime import run_to_end, shared_folder, stream_session
from tillstream.streaming.sinks import append_days

FIRST_DAY, PART_DAYS, PARTS = "1995-01-01", 500, 5  # of the tables' order dates
USER_SHARDS = 16
GROUP = "restarts"
USER = "1"


def _start(writer, root: str, name: str) -> None:
    run_to_end(jobs.start(writer, checkpoint_path(root, GROUP, name), name, available_now=True))


def _feed(writer, root: str, name: str, arrivals: Iterable[Callable[[], object]]) -> list:
    """Starts a job, lets the parts arrive one after the other, each a micro-batch at least, and stops it; returns its progress reports."""
    stream = writer.option("checkpointLocation", checkpoint_path(root, GROUP, name)).queryName(name).trigger(processingTime="0 seconds").start()
    try:
        for arrive in arrivals:
            arrive()
            stream.processAllAvailable()
        return stream.recentProgress
    finally:
        stream.stop()


def _parts(rows: DataFrame, part: Column, root: str, name: str) -> Callable[[int], DataFrame]:
    """Rows written by part; returns the reader of a part."""
    rows.withColumn("_part", part).write.partitionBy("_part").parquet(f"{root}/parts/{name}")
    return lambda k: rows.sparkSession.read.parquet(f"{root}/parts/{name}").where(F.col("_part") == k).drop("_part")


def _as_values(rows: DataFrame) -> DataFrame:
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))


@query
def topic_offsets_resume(spark, sf_dir):
    """Every record once: from the earliest on, then by a new query from stored offsets, which is stopped and goes on from its checkpoint."""
    session, root = stream_session(spark), shared_folder(spark, "topic-offsets")
    part = _parts(shop.table(spark, sf_dir, "events").select("event_id", "event_type"), F.pmod("event_id", F.lit(3)), root, "events")
    path = f"{root}/landed"

    def land(offsets, name):
        _start(jobs.landed(open_topic(session, f"{root}/topics", "events", offsets), GROUP, path), root, name)

    append(_as_values(part(0)), f"{root}/topics", "events")
    land("earliest", "one")
    stored = manifests.published_offsets(spark, path, "events", GROUP)
    for k in (1, 2):
        append(_as_values(part(k)), f"{root}/topics", "events")
        land(stored, "two")
    value = F.col("value")
    rows = manifests.read_published(spark, path, "records", jobs.LANDED)
    return rows.select(json_field(value, "event_id").cast("long").alias("event_id"), json_field(value, "event_type").alias("event_type"))


@query
def trademark_stats_published(spark, sf_dir):
    """Statistics and offsets appear together: a query that is killed between writing and publishing shows neither, and a new one starts
    where the published offsets say."""
    session, root = stream_session(spark), shared_folder(spark, "published")
    lines = lookups.with_sku(flows.allocated_all(spark, sf_dir), flows.sku_dimension(spark, sf_dir)).select(
        "order_id", "order_detail_id", "tm_id", "tm_name", from_cents(F.col("final_detail_c")).alias("final_detail_amount")
    )
    part = _parts(lines, F.pmod("order_detail_id", F.lit(2)), root, "lines")
    path, topics = f"{root}/stats", f"{root}/topics"

    def killed():
        raise RuntimeError("killed between writing and publishing")

    def job(offsets, before=None):
        return jobs.published_trademark_stats(open_topic(session, topics, DWS_ORDER_WIDE, offsets), GROUP, path, before)

    append(_as_values(part(0)), topics, DWS_ORDER_WIDE)
    _start(job("earliest"), root, "stats")
    append(_as_values(part(1)), topics, DWS_ORDER_WIDE)
    try:
        _start(job("earliest", killed), root, "stats")
    except StreamingQueryException:
        pass  # as meant: its folders are written, and no manifest names them
    _start(job(manifests.published_offsets(spark, path, DWS_ORDER_WIDE, GROUP)), root, "stats-anew")
    return manifests.read_published(spark, path, "stats", jobs.STATS).groupBy("trademark_id", "trademark_name").agg(
        from_cents(F.sum(to_cents(F.col("amount")))).alias("amount")
    )


def _part_of(day: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.floor(F.datediff(day, F.lit(FIRST_DAY)) / PART_DAYS), F.lit(PARTS - 1))).cast("int")


@query
def first_order_flag_keyed(spark, sf_dir):
    """Whole flagged orders from state per user, over five parts of the orders; users known before are its initial state."""
    session, root = stream_session(spark), shared_folder(spark, "first-orders")
    heads = orders.in_amounts(shop.orders(spark, sf_dir), orders.ORDER_MONEY)
    part = _parts(heads, _part_of(F.to_date("create_time")), root, "orders")
    topic, topics = f"{ODS_PREFIX}order_info", f"{root}/topics"
    append(_as_values(part(0)), topics, topic)
    job = jobs.flagged_orders(
        open_topic(session, topics, topic, "earliest"), shop.consumed_users(session, sf_dir), f"{root}/flagged", f"{root}/bad"
    )
    later = [lambda k=k: append(_as_values(part(k)), topics, topic) for k in range(1, PARTS)]
    _feed(job, root, "flagged_orders", [lambda: None, *later])
    money = [c for c in orders.ORDER_MONEY]
    return read_log(spark, f"{root}/flagged").select("id", "user_id", "province_id", "order_status", "create_time", *money, "if_first_order")


@query
def paid_allocation_keyed(spark, sf_dir):
    """Every line's share from state per order: the lines of an order come in up to five micro-batches."""
    session, root = stream_session(spark), shared_folder(spark, "open-orders")
    part = parts_of(spark, flows.pair_slices(spark, sf_dir), F.pmod("order_detail_id", F.lit(PARTS)), f"{root}/parts/pairs")

    def arrive(k):
        append(_as_values(part.read(k)), f"{root}/topics", "pairs")
        part.drop(k)

    arrive(0)
    job = jobs.allocated_lines(open_topic(session, f"{root}/topics", "pairs", "earliest"), part.layout, f"{root}/allocated")
    _feed(job, root, "allocated_lines", [lambda: None, *[lambda k=k: arrive(k) for k in range(1, PARTS)]])
    return read_log(spark, f"{root}/allocated").select(
        "order_id", "order_detail_id", "sku_id", "sku_num", "order_status", "create_time", "amount_c",
        from_cents(F.col("final_detail_c")).alias("final_detail_amount"),
    )


@query
def dau_first_visit_keyed(spark, sf_dir):
    """Whole first records per device and day from keys that live 24 hours after their last record; logs come in parts of eight days."""
    session, root = stream_session(spark), shared_folder(spark, "devices")
    logs = shop.app_logs(spark, sf_dir).where(json_field(F.col("value"), "start").isNotNull())
    day = F.to_date(F.timestamp_millis(json_field(F.col("value"), "ts").cast("long")))
    part = _parts(logs.select("value"), F.least(F.greatest(F.floor(F.datediff(day, F.lit("2024-01-01")) / 8), F.lit(0)), F.lit(3)).cast("int"), root, "logs")
    append(part(0), f"{root}/topics", STARTUP_LOG)
    job = jobs.daily_active_keyed(open_topic(session, f"{root}/topics", STARTUP_LOG, "earliest"), f"{root}/dau", f"{root}/bad")
    later = [lambda k=k: append(part(k), f"{root}/topics", STARTUP_LOG) for k in range(1, 4)]
    _feed(job, root, "daily_active_keyed", [lambda: None, *later])
    return read_log(spark, f"{root}/dau").select(*DAU_INFO.fieldNames())


@query
def order_line_outer_stream(spark, sf_dir):
    """Pairs and rows of one side from a join that lets go of what it has waited for long enough.

    The topics lack one order in 13, and the lines of one order in 17. A line in five of a part's last 30 days comes a part later. The last
    arrivals only carry the time forward.
    """
    session, root = stream_session(spark), shared_folder(spark, "one-sided")
    session.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")  # the next arrival lets go of what is overdue
    days = shop.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("order_status"), "o_orderdate")
    heads = days.where("id % 13 <> 0").select("id", "order_status", F.col("o_orderdate").cast("string").alias("at"))
    lines = shop.order_lines(spark, sf_dir).where("order_id % 17 <> 0").join(days.select(F.col("id").alias("order_id"), "o_orderdate"), "order_id")
    lines = lines.select(F.col("id").alias("order_detail_id"), "order_id", "sku_id", F.col("o_orderdate").cast("string").alias("at"))
    day = F.datediff(F.to_date("at"), F.lit(FIRST_DAY))
    late = (day % PART_DAYS >= PART_DAYS - 30) & (F.pmod("order_detail_id", F.lit(5)) == 0) & day.between(0, (PARTS - 1) * PART_DAYS)
    order_part = _parts(heads, _part_of(F.to_date("at")), root, "heads")
    line_part = _parts(lines, _part_of(F.to_date("at")) + F.when(late, 1).otherwise(0), root, "lines")
    topics = f"{root}/topics"

    def arrive(k):
        """Orders and lines of a part in one append, told apart by their key."""
        if k < PARTS:
            new_orders, new_lines = order_part(k), line_part(k)
        else:
            end = F.lit(f"2100-01-0{k - PARTS + 1}").alias("at")
            new_orders = spark.range(1).select(F.lit(-1).alias("id"), end)
            new_lines = spark.range(1).select(F.lit(-1).alias("order_detail_id"), F.lit(-2).alias("order_id"), end)
        sides = [_as_values(rows).withColumn("key", F.lit(key)) for key, rows in (("order", new_orders), ("line", new_lines))]
        append(sides[0].unionByName(sides[1]), topics, "sides")

    def side(key):
        return open_topic(session, topics, "sides", "earliest").where(F.col("key") == key)

    arrive(0)
    job = jobs.matched_sides(side("order"), side("line"), heads.schema, lines.schema, f"{root}/matched", "40 days")
    _feed(job, root, "matched_sides", [lambda: None, *[lambda k=k: arrive(k) for k in range(1, PARTS + 2)]])
    names = ["order_detail_id", "order_id", "sku_id", "id", "order_status", "side"]
    pairs = manifests.read_published(spark, f"{root}/matched", "pairs", jobs.matched_layout(heads.schema, lines.schema))
    return pairs.unionByName(manifests.read_published(spark, f"{root}/matched", "alone", pairs.schema)).select(*names)


@query
def sku_snapshot_lookup(spark, sf_dir):
    """Products are upserted in two batches, compacted, read by name and joined to the order lines by key."""
    root, versions = shared_folder(spark, "sku-snapshot"), shop.part_versions(spark, sf_dir)
    layout = versions.drop("version").schema
    for version in (1, 2):
        snapshots.upsert(versions.where(F.col("version") == version).drop("version"), root)
    snapshots.compact(spark, root, layout, "id", int(spark.conf.get("spark.sql.shuffle.partitions")))
    snapshots.create_view(spark, "sku_snapshot", root, layout, "id")
    lines = shop.order_lines(spark, sf_dir).select("id", F.col("sku_id").cast("string").alias("sku_id"))
    products = spark.table("sku_snapshot").select(F.col("id").alias("sku_id"), "sku_name")
    return lines.join(products, "sku_id", "left").select("id", "sku_id", "sku_name")


@query
def batch_ranges_ledger(spark, sf_dir):
    """Records per topic as a listener's ledger of offset ranges has them, over three starts, with the ranges of a partition joined end to end."""
    session, root = stream_session(spark), shared_folder(spark, "ranges")
    part = _parts(shop.table(spark, sf_dir, "events").select("event_id"), F.pmod("event_id", F.lit(3)), root, "events")
    ledger = RangeLedger(session, f"{root}/ranges")
    session.streams.addListener(ledger)
    try:
        for k in range(3):
            append(_as_values(part(k)), f"{root}/topics", "events")
            _start(jobs.landed(open_topic(session, f"{root}/topics", "events", "earliest"), GROUP, f"{root}/landed"), root, "landed")
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        session.streams.removeListener(ledger)
    ranges = read_ranges(spark, f"{root}/ranges").where("end_offset > begin_offset")
    partitions = ranges.groupBy("partition_id").agg(
        F.sum(F.col("end_offset") - F.col("begin_offset")).alias("n"), (F.max("end_offset") - F.min("begin_offset")).alias("span")
    )
    return partitions.agg(F.sum("n").alias("records"), F.sum("span").alias("span"))


@query
def dau_on_days_of_a_user(spark, sf_dir):
    """Devices per day in the stored daily index, on the days on which one user was there."""
    root, visits = shared_folder(spark, "stored-days"), flows.daily_active(spark, sf_dir)
    for batch_id in (0, 1):
        append_days(visits.where(F.pmod(F.xxhash64("mid"), F.lit(2)) == batch_id), root, batch_id)
    days = flows.start_logs(spark, sf_dir).where(F.col("common.uid") == USER).select("dt")
    return read_days(spark, root, days).groupBy("dt").agg(F.count(F.lit(1)).alias("value"))


@query
def order_user_sharded(spark, sf_dir):
    """Orders of five parts with their users; users are upserted in two batches, and a micro-batch reads the shards of its users only."""
    session, root = stream_session(spark), shared_folder(spark, "order-users")
    users, third = shop.users(spark, sf_dir), F.pmod(F.col("id").cast("long"), F.lit(3)) == 0
    sharded.upsert(users.withColumn("age_group", F.when(third, "unknown").otherwise(F.col("age_group"))), f"{root}/users", "id", 0, USER_SHARDS)
    sharded.upsert(users.where(third), f"{root}/users", "id", 1, USER_SHARDS)
    heads = shop.order_heads(spark, sf_dir).select("id", "user_id", "create_time")
    part = _parts(heads, _part_of(F.to_date("create_time")), root, "orders")
    topic, topics = f"{ODS_PREFIX}order_info", f"{root}/topics"
    append(_as_values(part(0)), topics, topic)
    job = jobs.order_users(open_topic(session, topics, topic, "earliest"), f"{root}/users", users.schema, f"{root}/joined", f"{root}/bad")
    _feed(job, root, "order_users", [lambda: None, *[lambda k=k: append(_as_values(part(k)), topics, topic) for k in range(1, PARTS)]])
    return read_log(spark, f"{root}/joined").select("id", "user_id", "user_age_group", "user_gender")
