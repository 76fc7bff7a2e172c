"""Shop records as views over the driver's tables.

The driver has no shop data, so orders, order lines, dimensions and logs are derived from its tables by column expressions.
Ids of dimension members and of order lines come from a hash of their content: no ranking over a whole table and no
shuffle is needed to make them, and the SQL checks can compute the same values. A line is known by (order id, line id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Its schema is read from a file footer once, not by a job for every use."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def content_id(text: Column) -> Column:
    """60 bits of the MD5 of a text as a positive long."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


# Modulus and multipliers of the line hash (fixed values; the SQL checks use the same).
HASH_PRIME = 2147483647
HASH_MULTIPLIERS = (1000003, 998244353)


def numbers_id(*values: Column) -> Column:
    """62 bits from long columns: two polynomial hashes, each modulo a 31-bit prime. Plain long arithmetic, no text."""

    def polynomial(multiplier: int) -> Column:
        h = F.lit(7).cast("long")
        for value in values:
            h = (h * multiplier + value % HASH_PRIME) % HASH_PRIME
        return h

    first, second = HASH_MULTIPLIERS
    return polynomial(first) * HASH_PRIME + polynomial(second)


def _rounded(value: Column) -> Column:
    """Nearest whole number of a positive double; ``floor`` stays in machine arithmetic where ``round`` goes through decimals."""
    return F.floor(value + F.lit(0.5))


def provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        key.cast("string").alias("id"),
        F.col("n_name").alias("name"),
        (F.lit(100000) + key * 1000).cast("string").alias("area_code"),
        F.concat(F.lit("XX-"), key.cast("string")).alias("iso_code"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User dimension."""
    key = F.col("c_custkey")
    age = (
        F.when(key % 4 == 0, "<20").when(key % 4 == 1, "20-29").when(key % 4 == 2, "30-39").otherwise("40+")
    )
    return table(spark, sf_dir, "customer").select(
        key.cast("string").alias("id"),
        F.col("c_mktsegment").alias("user_level"),
        F.when(key % 2 == 0, "M").otherwise("F").alias("gender"),
        age.alias("age_group"),
        F.when(key % 2 == 0, "male").otherwise("female").alias("gender_name"),
    )


def consumed_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users that had ordered before: one customer in ten."""
    return table(spark, sf_dir, "customer").where("c_custkey % 10 = 0").select(
        F.col("c_custkey").cast("string").alias("user_id"), F.lit("1").alias("if_consumed")
    )


def _tm_id() -> Column:
    return F.split_part(F.col("p_brand"), F.lit("#"), F.lit(2))


def trademarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(_tm_id().alias("id"), F.col("p_brand").alias("tm_name")).distinct()


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select(F.col("p_type").alias("name")).distinct()
    return names.select(content_id(F.col("name")).cast("string").alias("id"), "name", F.lit("1").alias("category2_id"))


def spus(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select(F.col("p_name").alias("spu_name")).distinct()
    return names.select(content_id(F.col("spu_name")).cast("string").alias("id"), "spu_name")


def sku_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products before the dimension lookups."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        content_id(F.col("p_name")).cast("string").alias("spu_id"),
        F.col("p_retailprice").cast("string").alias("price"),
        F.col("p_name").alias("sku_name"),
        _tm_id().alias("tm_id"),
        content_id(F.col("p_type")).cast("string").alias("category3_id"),
        F.lit(None).cast("string").alias("create_time"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = [F.col(c).cast("long") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    content += [_rounded(F.col(c) * 100) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")]
    content += [F.unix_date(F.to_date("l_shipdate")).cast("long")]
    return table(spark, sf_dir, "lineitem").select(
        numbers_id(*content).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        _rounded(F.col("l_quantity")).alias("sku_num"),
        _rounded(F.col("l_extendedprice") * 100 / F.col("l_quantity")).alias("order_price_c"),
        F.concat(F.lit("sku "), F.col("l_partkey").cast("string")).alias("sku_name"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that have lines. ``final = original - benefit + freight``; the date gets a second of the day from the order key."""
    return with_totals(order_heads(spark, sf_dir), order_lines(spark, sf_dir))


def with_totals(heads: DataFrame, lines: DataFrame) -> DataFrame:
    totals = lines.groupBy(F.col("order_id").alias("id")).agg(
        F.sum(F.col("order_price_c") * F.col("sku_num")).alias("original_total_c")
    )
    return heads.join(totals, "id").withColumn(
        "final_total_c", F.col("original_total_c") - F.col("benefit_reduce_c") + F.col("feight_fee_c")
    )


def order_heads(spark: SparkSession, sf_dir: str, day: str | None = None) -> DataFrame:
    """Orders without the totals of their lines; with ``day`` those of that day only, which the scan can select."""
    key = F.col("o_orderkey")
    second = F.make_dt_interval(secs=(key * 7919 % 86400).cast("decimal(18,6)"))
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    rows = table(spark, sf_dir, "orders")
    if day is not None:
        begin = F.lit(day).cast("date")
        rows = rows.where((F.col("o_orderdate") >= begin) & (F.col("o_orderdate") < F.date_add(begin, 1)))
    return rows.join(customer, "o_custkey").select(
        key.alias("id"),
        F.col("c_nationkey").cast("long").alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        (key % 50 * 100).alias("benefit_reduce_c"),
        (key % 20 * 100).alias("feight_fee_c"),
        (F.col("o_orderdate") + second).cast("string").alias("create_time"),
    )


def app_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App log texts made of the events: a ``view`` is a start-up log, anything else an event log."""
    user = F.col("user_id")
    common = F.struct(
        F.concat(F.lit("mid_"), user.cast("string")).alias("mid"),
        user.cast("string").alias("uid"),
        F.concat(F.lit("ar_"), (user % 34).cast("string")).alias("ar"),
        F.concat(F.lit("ch_"), (user % 5).cast("string")).alias("ch"),
        F.concat(F.lit("v2."), (user % 3).cast("string")).alias("vc"),
    )
    start = F.when(F.col("event_type") == "view", F.struct(F.lit("icon").alias("entry")))
    log = F.struct(common.alias("common"), start.alias("start"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"))
    return table(spark, sf_dir, "events").select("event_id", F.to_json(log).alias("value"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search documents: a text, a number to sort by and a nested list to filter on."""
    people = F.array(
        F.struct(F.lit(0).cast("long").alias("id"), F.col("lang").alias("name")),
        F.struct(F.lit(1).cast("long").alias("id"), F.col("source").alias("name")),
    )
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("name"), F.col("n_chars").alias("score"), people.alias("actor_list")
    )


def change_envelopes(spark: SparkSession, sf_dir: str, single_objects: bool = False) -> DataFrame:
    """Change envelopes made of the orders: several types and tables, ``data`` with two, one, no rows or null.

    With ``single_objects`` the lower-case spelling of the second capture tool comes with a lone object in ``data``.
    """
    key = F.col("o_orderkey")
    row = F.struct(
        key.cast("string").alias("id"), F.col("o_custkey").cast("string").alias("user_id"), F.col("o_orderstatus").alias("order_status")
    )
    second = F.struct(
        F.concat(key.cast("string"), F.lit("-b")).alias("id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"),
    )
    kind = F.when(key % 4 == 0, "UPDATE").when(key % 4 == 1, "insert").otherwise("INSERT").alias("type")
    table_name = F.when(key % 5 == 0, "order_detail").otherwise("order_info").alias("table")
    data = (
        F.when(key % 7 == 0, F.lit(None))
        .when(key % 11 == 0, F.slice(F.array(row), 1, 0))
        .when(key % 3 == 0, F.array(row, second))
        .otherwise(F.array(row))
        .alias("data")
    )
    value = F.to_json(F.struct(kind, table_name, data))
    if single_objects:
        value = F.when((key % 4 == 1) & (key % 7 != 0), F.to_json(F.struct(kind, table_name, row.alias("data")))).otherwise(value)
    return table(spark, sf_dir, "orders").select(value.alias("value"))


def row_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded row-change entries made of the orders."""
    key = F.col("o_orderkey")

    def columns(order_id: Column) -> Column:
        return F.array(
            F.struct(F.lit("id").alias("name"), order_id.alias("value")),
            F.struct(F.lit("order_status").alias("name"), F.col("o_orderstatus").alias("value")),
        )

    one, two = columns(key.cast("string")), columns(F.concat(key.cast("string"), F.lit("-b")))
    return table(spark, sf_dir, "orders").select(
        F.when(key % 10 == 0, "TRANSACTIONBEGIN").when(key % 10 == 9, "TRANSACTIONEND").otherwise("ROWDATA").alias("entry_type"),
        F.when(key % 3 == 0, "order_detail").otherwise("order_info").alias("table"),
        F.when(key % 4 == 0, "UPDATE").otherwise("INSERT").alias("event_type"),
        F.when(key % 7 == 0, F.array(one, two)).otherwise(F.array(one)).alias("rows"),
    )


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order records as JSON texts in which every value is text, as change records carry them."""
    return table(spark, sf_dir, "orders").select(
        F.to_json(
            F.struct(
                F.col("o_orderkey").cast("string").alias("id"),
                F.col("o_custkey").cast("string").alias("user_id"),
                F.col("o_orderstatus").alias("order_status"),
                F.round(F.col("o_totalprice") * 100).cast("long").cast("string").alias("final_total_amount"),
                (F.col("o_orderdate") + F.make_dt_interval(secs=(F.col("o_orderkey") * 7919 % 86400).cast("decimal(18,6)")))
                .cast("string")
                .alias("create_time"),
            )
        ).alias("value")
    )


def part_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two generations of product rows: all parts, then every third one with a new name."""
    parts = table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string").alias("id")
    first = parts.select(key, F.col("p_name").alias("sku_name"), F.lit(1).alias("version"))
    second = parts.where("p_partkey % 3 = 0").select(
        key, F.concat(F.lit("new "), F.col("p_name")).alias("sku_name"), F.lit(2).alias("version")
    )
    return first.unionByName(second)


def topic_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as records of a topic with four partitions, each with the micro-batch (one per day) that read it."""
    key = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.lit("events").alias("topic"),
        (key % 4).cast("int").alias("partition"),
        F.call_function("div", key, F.lit(4)).cast("long").alias("offset"),
        F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).cast("long").alias("batch_id"),
    )
