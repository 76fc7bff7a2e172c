"""The batch flow from shop records to the allocated wide rows."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.operators import dau, lookups, orders, sales, wide
from tillstream.sources import shop
from tillstream.sources.records import json_field, parse_app_log
from tillstream.streaming import manifests
from tillstream.streaming.runtime import dropping_shuffles, shared_folder

SLICE_BYTES = 256 << 20  # of the table of order lines, at most, that one pass shuffles at a time
SLICE = "_slice"


def slices(spark: SparkSession, sf_dir: str) -> int:
    """In how many passes the order lines are written: the shuffles of one pass leave the disk before the next."""
    return max(1, -(-manifests.size(spark, f"{sf_dir}/lineitem.parquet") // SLICE_BYTES))


def slice_of(order_id: str, n: int) -> Column:
    return F.pmod(F.xxhash64(F.col(order_id).cast("long")), F.lit(n)).cast("int")


def in_slices(spark: SparkSession, sf_dir: str) -> Iterator[tuple[DataFrame, DataFrame]]:
    """Orders without totals and their lines, cut into passes by the order id. An order is in one pass with all of its lines."""
    n, heads, lines = slices(spark, sf_dir), shop.order_heads(spark, sf_dir), shop.order_lines(spark, sf_dir)
    for k in range(n):
        yield (heads, lines) if n == 1 else (heads.where(slice_of("id", n) == k), lines.where(slice_of("order_id", n) == k))


def sku_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.with_names(
        shop.sku_source(spark, sf_dir), shop.categories(spark, sf_dir), shop.trademarks(spark, sf_dir), shop.spus(spark, sf_dir)
    )


def enriched_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with date parts, first-order flag, province and user."""
    rows = orders.with_date_parts(shop.orders(spark, sf_dir))
    flagged = orders.flag_first_orders(rows, shop.consumed_users(spark, sf_dir))
    placed = lookups.with_province(flagged, shop.provinces(spark, sf_dir))
    return lookups.with_user(placed, shop.users(spark, sf_dir))


def enriched_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.with_sku(shop.order_lines(spark, sf_dir), sku_dimension(spark, sf_dir))


def allocated_day(spark: SparkSession, sf_dir: str, day: str) -> DataFrame:
    """The pairs of one day. A line has its order's day, so the day's orders select the lines before anything is summed."""
    heads, lines = shop.order_heads(spark, sf_dir, day), shop.order_lines(spark, sf_dir)
    lines = lines.join(heads.select(F.col("id").alias("order_id")), "order_id", "left_semi")
    return wide.allocated_pairs(orders.with_date_parts(shop.with_totals(heads, lines)), lines)


def allocated_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of plain orders and lines with the allocated amount."""
    return wide.allocated_pairs(orders.with_date_parts(shop.orders(spark, sf_dir)), shop.order_lines(spark, sf_dir))


def pair_slices(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """Pairs of plain orders and lines, once each and not allocated yet, in the passes of :func:`in_slices`."""
    for heads, lines in in_slices(spark, sf_dir):
        sides = wide.order_side(orders.with_date_parts(shop.with_totals(heads, lines))).dropDuplicates(["order_id"])
        yield wide.line_side(lines).join(sides, "order_id").dropDuplicates(wide.PAIR)


def trademark_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allocated amount per brand. Amounts are summed per product first, so the product lookup sees one row per product."""
    per_sku = allocated_all(spark, sf_dir).groupBy("sku_id").agg(F.sum("final_detail_c").alias("final_detail_c"))
    return sales.trademark_sales(lookups.with_sku(per_sku, sku_dimension(spark, sf_dir)))


def wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide records of all orders and lines. Product names join last, so that they take no part in the shuffle by order."""
    return _wide(enriched_orders(spark, sf_dir), shop.order_lines(spark, sf_dir), sku_dimension(spark, sf_dir))


def _wide(heads: DataFrame, lines: DataFrame, skus: DataFrame) -> DataFrame:
    return wide.wide_records(lookups.with_sku(wide.allocated_pairs(heads, lines), skus))


def wide_slices(spark: SparkSession, sf_dir: str, root: str) -> Iterator[DataFrame]:
    """:func:`wide_rows` in the passes of :func:`in_slices`. With several, the orders and products lie below ``root`` meanwhile.

    A user's first order is sought among all orders, so those are enriched at once; they are a fraction of the lines.
    """
    n = slices(spark, sf_dir)
    if n == 1:
        yield wide_rows(spark, sf_dir)
        return
    heads, skus = enriched_orders(spark, sf_dir), sku_dimension(spark, sf_dir)
    with dropping_shuffles(spark):
        heads.withColumn(SLICE, slice_of("id", n)).write.partitionBy(SLICE).parquet(f"{root}/heads")
        skus.write.parquet(f"{root}/skus")
    layout = T.StructType([*heads.schema.fields, T.StructField(SLICE, T.IntegerType())])
    for k in range(n):
        part = spark.read.schema(layout).parquet(f"{root}/heads").where(F.col(SLICE) == k).drop(SLICE)
        lines = shop.order_lines(spark, sf_dir).where(slice_of("order_id", n) == k)
        yield _wide(part, lines, spark.read.schema(skus.schema).parquet(f"{root}/skus"))
    for table in ("heads", "skus"):
        manifests.remove(spark, f"{root}/{table}")


def wide_rows_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`wide_rows`, from a table that the passes have written where there are several."""
    if slices(spark, sf_dir) == 1:
        return wide_rows(spark, sf_dir)
    root = shared_folder(spark, "wide-rows")
    with dropping_shuffles(spark):
        for rows in wide_slices(spark, sf_dir, root):
            layout = rows.schema
            rows.write.mode("append").parquet(f"{root}/rows")
    return spark.read.schema(layout).parquet(f"{root}/rows")


def start_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed start-up logs with day and hour, and the event id to order logs of one millisecond."""
    logs = shop.app_logs(spark, sf_dir).where(json_field(F.col("value"), "start").isNotNull())
    return dau.with_day_and_hour(parse_app_log(logs, keep=["event_id"]).good)


def daily_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = dau.to_dau_info(start_logs(spark, sf_dir), "event_id")
    return dau.first_visits(records, ["ts", "event_id"]).drop("event_id")
