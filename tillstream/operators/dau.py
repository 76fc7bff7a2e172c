"""Daily active devices (FN1-FN3, FN5, DD1, AG4, AG5, J8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions.clock import previous_day, shop_date, shop_hour
from tillstream.functions.money import zero_if_null
from tillstream.operators.dedup import SALTS, dedup_stream, first_per_key


def with_day_and_hour(logs: DataFrame) -> DataFrame:
    """Adds the shop's day ``dt`` and unpadded hour ``hr`` of ``ts`` (epoch milliseconds)."""
    return logs.withColumns({"dt": shop_date(F.col("ts")), "hr": shop_hour(F.col("ts"))})


def to_dau_info(logs: DataFrame, *extra: str) -> DataFrame:
    """Flat daily-active records of start-up logs that have ``dt`` and ``hr``."""
    return logs.select("common.mid", "common.uid", "common.ar", "common.ch", "common.vc", "dt", "hr", F.lit("00").alias("mi"), "ts", *extra)


def first_visits(logs: DataFrame, order: list[str]) -> DataFrame:
    """The first record of each device and day (batch)."""
    return first_per_key(logs, ["dt", "mid"], order)


def first_visits_stream(logs: DataFrame, lateness: str = "2 days", salts: int = SALTS) -> DataFrame:
    """The first record of each device and day to arrive.

    ``lateness`` must be a day at least: a device seen early and late on one day counts once.
    """
    timed = logs.withColumn("_time", F.timestamp_millis("ts")).withWatermark("_time", lateness)
    return dedup_stream(timed, ["dt", "mid"], salts).drop("_time")


def with_new_devices(logs: DataFrame, time: str, wait: str, salts: int = SALTS) -> DataFrame:
    """A stream of the logs, plus one row (``_new`` true, only ``dt`` and ``mid`` set) at a device's first appearance on a day.

    Spark's own de-duplication state remembers the devices for ``wait``, which must be a day at least: whatever is not too late by then
    still finds its device. :func:`first_of_new_devices` turns a micro-batch of this stream into first records.
    """
    timed = logs.withWatermark(time, wait)
    new = dedup_stream(timed.select("dt", "mid", time, "offset"), ["dt", "mid"], salts).select("dt", "mid", F.lit(True).alias("_new"))
    return logs.withColumn("_new", F.lit(False)).unionByName(new, allowMissingColumns=True).drop(time)


def first_of_new_devices(batch: DataFrame, order: list[str]) -> DataFrame:
    """The first record of each device and day that the micro-batch is the first to have."""
    new = batch.where("_new").select("dt", "mid")
    return first_per_key(batch.where("not _new").drop("_new").join(new, ["dt", "mid"], "left_semi"), ["dt", "mid"], order)


def active_total(dau: DataFrame, day: str) -> DataFrame:
    """Number of devices on a day, 0 for a day without any."""
    return dau.where(F.col("dt") == day).agg(zero_if_null(F.count(F.lit(1))).alias("value"))


def active_by_hour(dau: DataFrame, day: str) -> DataFrame:
    return dau.where(F.col("dt") == day).groupBy("hr").agg(F.count(F.lit(1)).alias("value"))


def active_two_days(dau: DataFrame, day: str) -> DataFrame:
    """Devices per hour on a day and the day before, hour by hour; NULL where a day has none in that hour."""
    before = previous_day(day)

    def count_on(wanted):
        return F.sum(F.when(F.col("dt") == wanted, 1))

    two_days = dau.where(F.col("dt").isin(day, before))
    return two_days.groupBy("hr").agg(count_on(before).alias("yesterday"), count_on(day).alias("today"))
