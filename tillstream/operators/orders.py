"""Orders: date parts and the first-order flag (FN4, J1, W1, W2, AG8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions.clock import text_date, text_hour
from tillstream.functions.money import from_cents, to_cents
from tillstream.operators.dedup import first_per_key


# Money fields of the records and their names in cents.
ORDER_MONEY = {
    "final_total_amount": "final_total_c", "benefit_reduce_amount": "benefit_reduce_c",
    "original_total_amount": "original_total_c", "feight_fee": "feight_fee_c",
}
LINE_MONEY = {"order_price": "order_price_c"}


def in_cents(records: DataFrame, money: dict[str, str]) -> DataFrame:
    """Record amounts (doubles) as integer cents under their inside names."""
    return records.withColumns({c: to_cents(F.col(a)) for a, c in money.items()}).drop(*money)


def in_amounts(rows: DataFrame, money: dict[str, str]) -> DataFrame:
    """The reverse of :func:`in_cents`."""
    return rows.withColumns({a: from_cents(F.col(c)) for a, c in money.items()}).drop(*money.values())


def with_date_parts(orders: DataFrame) -> DataFrame:
    """Adds ``create_date`` and ``create_hour``, cut from the text of ``create_time``."""
    return orders.withColumns(
        {"create_date": text_date(F.col("create_time")), "create_hour": text_hour(F.col("create_time"))}
    )


def earliest_order_ids(orders: DataFrame) -> DataFrame:
    """(user_id, id) of each user's earliest order; equal times are decided by the order id.

    A minimum per user, so a user with very many orders costs one row per task in the shuffle.
    """
    earliest = orders.groupBy("user_id").agg(F.min(F.struct("create_time", "id")).alias("_first"))
    return earliest.select("user_id", F.col("_first.id").alias("id"))


def without_users(rows: DataFrame, known_users: DataFrame) -> DataFrame:
    """Rows whose ``user_id`` (a number) is not among the known users (texts)."""
    known = known_users.select(F.col("user_id").try_cast("long").alias("_known"))
    return rows.join(known, F.col("user_id") == F.col("_known"), "left_anti")


def mark_orders(orders: DataFrame, first_ids: DataFrame) -> DataFrame:
    """``if_first_order`` is ``1`` for the given order ids and ``0`` for all others.

    The join is on the order id, which is unique, so no user's orders meet in one task, and its partitioning serves the
    join with the order lines that follows.
    """
    marks = first_ids.select("id", F.lit("1").alias("_mark"))
    return orders.join(marks, "id", "left").withColumn("if_first_order", F.coalesce("_mark", F.lit("0"))).drop("_mark")


def flag_first_orders(orders: DataFrame, known_users: DataFrame) -> DataFrame:
    """Flags the earliest order of every user that has not ordered before (batch). Order ids must be unique."""
    return mark_orders(orders, without_users(earliest_order_ids(orders), known_users))


def new_consumers(flagged: DataFrame) -> DataFrame:
    """Users to add to ``user_status``: those with a first order."""
    return flagged.where(F.col("if_first_order") == "1").select(
        F.col("user_id").cast("string").alias("user_id"), F.lit("1").alias("if_consumed")
    )


def first_orders_only(orders: DataFrame) -> DataFrame:
    return first_per_key(orders, ["user_id"], ["create_time", "id"])


def single_order_users(orders: DataFrame) -> DataFrame:
    """Users with exactly one order."""
    return orders.groupBy("user_id").count().where("count = 1").select("user_id")


def with_order_counts(orders_stream: DataFrame) -> DataFrame:
    """A stream of the orders, plus a row (``_so_far`` set) per touched user with the number of their orders so far (update mode).

    Spark's aggregation state remembers the users for good, in one row each; orders are counted in each task before the shuffle.
    """
    counts = orders_stream.groupBy("user_id").agg(F.count(F.lit(1)).alias("_so_far"))
    return orders_stream.withColumn("_so_far", F.lit(None).cast("long")).unionByName(counts, allowMissingColumns=True)


def flag_once(batch: DataFrame, known_users: DataFrame | None = None) -> DataFrame:
    """Flagged orders of one micro-batch of :func:`with_order_counts`, each id once: first by batch, then by time.

    A user is new whose orders so far are those of the batch, copies counted on both sides.
    """
    rows, so_far = batch.where("_so_far is null").drop("_so_far"), batch.where("_so_far is not null").select("user_id", "_so_far")
    earliest = rows.groupBy("user_id").agg(F.min(F.struct("create_time", "id")).alias("_first"), F.count(F.lit(1)).alias("_now"))
    new = earliest.join(so_far, "user_id").where("_now = _so_far").select("user_id", F.col("_first.id").alias("id"))
    if known_users is not None:
        new = without_users(new, known_users)
    return mark_orders(rows.dropDuplicates(["id"]), new)


def flag_counted(batch: DataFrame, place: list[str], known_users: DataFrame | None = None) -> DataFrame:
    """Flagged orders of one micro-batch of :func:`with_order_counts`, all of them: first by batch, then by time, id and ``place``.

    ``place`` is where a record stands in its topic, so of an order that came several times one is flagged. A user is new whose
    orders so far are those of the batch. The marks are joined by place: a user's orders meet in no task.
    """
    rows, so_far = batch.where("_so_far is null").drop("_so_far"), batch.where("_so_far is not null").select("user_id", "_so_far")
    earliest = rows.groupBy("user_id").agg(F.min(F.struct("create_time", "id", *place)).alias("_first"), F.count(F.lit(1)).alias("_now"))
    new = earliest.join(so_far, "user_id").where("_now = _so_far")
    if known_users is not None:
        new = without_users(new, known_users)
    marks = new.select(*[F.col(f"_first.{c}").alias(c) for c in place], F.lit("1").alias("_mark"))
    return rows.join(marks, place, "left").withColumn("if_first_order", F.coalesce("_mark", F.lit("0"))).drop("_mark")
