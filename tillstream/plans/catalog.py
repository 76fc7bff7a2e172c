"""The registered batch queries. Each reads the driver's tables below ``sf_dir`` and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions.money import from_cents
from tillstream.operators import dau, lookups, orders, routing, sales, search, wide
from tillstream.plans import flows
from tillstream.schemas import ORDER_INFO_SOURCE
from tillstream.sources import shop
from tillstream.sources.records import json_field, parse_records
from tillstream.sources.tables import latest_per_key, read_log
from tillstream.streaming.progress import batch_offsets, latest_offsets
from tillstream.streaming.runtime import configure, shared_folder
from tillstream.streaming.sinks import append_batch

Query = Callable[[SparkSession, str], DataFrame]

DAU_DAY = "2024-01-15"
SALES_DAY = "1995-06-19"
SEARCH_TEXT = "the eau"
SEARCH_ACTOR = "en"
DOC_ID = 42

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


# Routing and change records


@query
def log_route(spark, sf_dir):
    return routing.route_logs(shop.app_logs(spark, sf_dir)).select("event_id", "topic")


def _change_fields(rows):
    names = ("id", "user_id", "order_status")
    return rows.select("topic", *[json_field(F.col("value"), n).alias(n) for n in names])


@query
def cdc_insert_route(spark, sf_dir):
    return _change_fields(routing.split_changes(shop.change_envelopes(spark, sf_dir)))


@query
def cdc_object_route(spark, sf_dir):
    return _change_fields(routing.split_changes_any(shop.change_envelopes(spark, sf_dir, single_objects=True)))


@query
def rowchange_flatten(spark, sf_dir):
    return routing.flatten_row_changes(routing.row_data_entries(shop.row_changes(spark, sf_dir)))


@query
def rowchange_one_table(spark, sf_dir):
    return routing.flatten_row_changes(routing.row_data_entries(shop.row_changes(spark, sf_dir), "order_info"))


# Daily active devices


@query
def dau_first_visit(spark, sf_dir):
    return flows.daily_active(spark, sf_dir)


@query
def dau_total(spark, sf_dir):
    return dau.active_total(flows.daily_active(spark, sf_dir), DAU_DAY)


@query
def dau_by_hour(spark, sf_dir):
    return dau.active_by_hour(flows.daily_active(spark, sf_dir), DAU_DAY)


@query
def dau_two_days(spark, sf_dir):
    return dau.active_two_days(flows.daily_active(spark, sf_dir), DAU_DAY)


@query
def dau_hour_map(spark, sf_dir):
    per_hour = dau.active_by_hour(flows.daily_active(spark, sf_dir), DAU_DAY)
    return sales.as_map(per_hour, "hr", "value").select(F.to_json("result").alias("result"))


# Orders


@query
def order_date_parts(spark, sf_dir):
    records = parse_records(shop.order_messages(spark, sf_dir), ORDER_INFO_SOURCE, ["id", "user_id"]).good
    return orders.with_date_parts(records).select(
        "id", "user_id", "order_status", "final_total_amount", "feight_fee", "create_date", "create_hour"
    )


@query
def first_order_flag(spark, sf_dir):
    flagged = orders.flag_first_orders(shop.order_heads(spark, sf_dir), shop.consumed_users(spark, sf_dir))
    return flagged.select("id", "user_id", "create_time", "if_first_order")


@query
def first_order_users(spark, sf_dir):
    return orders.new_consumers(orders.flag_first_orders(shop.order_heads(spark, sf_dir), shop.consumed_users(spark, sf_dir)))


@query
def first_orders_only(spark, sf_dir):
    return orders.first_orders_only(shop.order_heads(spark, sf_dir).select("user_id", "id", "create_time"))


@query
def single_order_users(spark, sf_dir):
    return orders.single_order_users(shop.order_heads(spark, sf_dir))


@query
def order_province(spark, sf_dir):
    heads = shop.order_heads(spark, sf_dir)
    joined = lookups.with_province(heads, shop.provinces(spark, sf_dir))
    return joined.select("id", "province_id", "province_name", "province_area_code", "province_iso_code")


@query
def order_user(spark, sf_dir):
    joined = lookups.with_user(shop.order_heads(spark, sf_dir), shop.users(spark, sf_dir))
    return joined.select("id", "user_id", "user_age_group", "user_gender")


# Dimensions


@query
def dim_sku(spark, sf_dir):
    return flows.sku_dimension(spark, sf_dir)


@query
def dim_upsert_latest(spark, sf_dir):
    return latest_per_key(shop.part_versions(spark, sf_dir), ["id"], ["version"])


@query
def order_detail_sku(spark, sf_dir):
    return flows.enriched_lines(spark, sf_dir).select(
        "id", "order_id", "sku_id", "sku_num", from_cents(F.col("order_price_c")).alias("order_price"),
        "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name",
    )


# Wide rows and allocation


@query
def order_wide(spark, sf_dir):
    return flows.wide_rows_saved(spark, sf_dir)


@query
def order_line_outer(spark, sf_dir):
    heads = shop.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("order_status")
    )
    lines = shop.order_lines(spark, sf_dir).select(F.col("id").alias("order_detail_id"), "order_id", "sku_id")
    return wide.match_sides(heads, lines)


@query
def order_running_sums(spark, sf_dir):
    sums = wide.running_sums(flows.allocated_all(spark, sf_dir))
    return sums.select("order_id", "order_detail_id", "amount_c", "final_detail_c", "origin_sum_c", "split_sum_c")


@query
def paid_allocation(spark, sf_dir):
    return flows.allocated_all(spark, sf_dir).select(
        "order_id", "order_detail_id", "sku_id", "amount_c", from_cents(F.col("final_detail_c")).alias("final_detail_amount")
    )


# Sales


@query
def trademark_sales(spark, sf_dir):
    return flows.trademark_totals(spark, sf_dir)


@query
def sales_day_total(spark, sf_dir):
    return sales.day_total(flows.allocated_day(spark, sf_dir, SALES_DAY), SALES_DAY)


@query
def sales_by_hour(spark, sf_dir):
    return sales.sales_by_hour(flows.allocated_day(spark, sf_dir, SALES_DAY), SALES_DAY)


@query
def sliding_window_sales(spark, sf_dir):
    events = shop.table(spark, sf_dir, "events").select("ts", F.round(F.col("value") * 100).cast("long").alias("value_c"))
    windows = sales.sliding_sums(events, "ts", "value_c")
    return windows.select(
        F.col("window_start").cast("string").alias("window_start"), F.col("window_end").cast("string").alias("window_end"),
        from_cents(F.col("amount")).alias("amount"), "n",
    )


# Search


@query
def doc_by_id(spark, sf_dir):
    return search.by_id(shop.documents(spark, sf_dir), DOC_ID).select("id", "name", "score")


@query
def search_match(spark, sf_dir):
    return search.match(shop.documents(spark, sf_dir), SEARCH_TEXT).select("id", "score")


@query
def search_term(spark, sf_dir):
    return search.term(shop.documents(spark, sf_dir), SEARCH_ACTOR).select("id", "score")


@query
def search_bool(spark, sf_dir):
    return search.match_and_term(shop.documents(spark, sf_dir), SEARCH_TEXT, SEARCH_ACTOR).select("id", "score")


@query
def search_page(spark, sf_dir):
    hits = search.match_and_term(shop.documents(spark, sf_dir), SEARCH_TEXT, SEARCH_ACTOR).select("id", "score")
    return search.page(hits, 0, 20)


@query
def search_page_ascending(spark, sf_dir):
    hits = search.match_and_term(shop.documents(spark, sf_dir), SEARCH_TEXT, SEARCH_ACTOR).select("id", "score")
    return search.page(hits, 10, 10, descending=False)


@query
def search_highlight(spark, sf_dir):
    hits = search.match(shop.documents(spark, sf_dir), SEARCH_TEXT)
    return search.with_highlight(hits, SEARCH_TEXT).select("id", "highlight")


@query
def search_total(spark, sf_dir):
    return search.total_hits(shop.documents(spark, sf_dir))


# Progress


@query
def offset_ledger_resume(spark, sf_dir):
    """Next offsets of every partition, from a ledger that two runs have written, the second from its batch 0 on."""
    log, path = shop.topic_log(spark, sf_dir), shared_folder(spark, "ledger")
    for run, batch_id, part in (("one", 0, "batch_id < 10"), ("one", 1, "batch_id between 10 and 19"), ("two", 0, "batch_id > 19")):
        append_batch(batch_offsets(log.where(part), "event_readers"), path, batch_id, run)
    return latest_offsets(read_log(spark, path)).select("group_id", "topic", "partition_id", "topic_offset")
