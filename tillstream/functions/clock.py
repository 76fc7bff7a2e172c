"""Dates and hours (FN1-FN4, FN9-FN11, FN15)."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

SHOP_ZONE = "Asia/Shanghai"


def shop_time(ts_ms: Column) -> Column:
    """Epoch milliseconds as wall-clock time of the shop."""
    return F.convert_timezone(None, F.lit(SHOP_ZONE), F.timestamp_millis(ts_ms))


def shop_date(ts_ms: Column) -> Column:
    """``yyyy-MM-dd`` of the shop's day."""
    return F.to_date(shop_time(ts_ms)).cast("string")


def shop_hour(ts_ms: Column) -> Column:
    """Hour of the shop's day as text, not padded."""
    return F.hour(shop_time(ts_ms)).cast("string")


def text_date(create_time: Column) -> Column:
    """The part of a ``yyyy-MM-dd HH:mm:ss`` text before the space."""
    return F.split_part(create_time, F.lit(" "), F.lit(1))


def text_hour(create_time: Column) -> Column:
    """The hour of a ``yyyy-MM-dd HH:mm:ss`` text, padded as in the text."""
    return F.split_part(F.split_part(create_time, F.lit(" "), F.lit(2)), F.lit(":"), F.lit(1))


def hour_of(create_time: Column) -> Column:
    """Hour number of a date-time text; NULL for a text that is none."""
    return F.hour(F.try_to_timestamp(create_time))


def padded_hour(hour: Column) -> Column:
    return F.lpad(hour.cast("string"), 2, "0")


def previous_day(day: str) -> str:
    """The day before ``day``; a text that is no date raises ``ValueError``."""
    return str(datetime.date.fromisoformat(day) - datetime.timedelta(days=1))


def previous_day_column(day: Column) -> Column:
    """Column form of :func:`previous_day`; a text that is no date fails the query (ANSI mode)."""
    return F.date_sub(F.to_date(day), 1).cast("string")


def processing_time(pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Time of the running query in the shop's zone. Spark fixes it once per query, so once per micro-batch."""
    return F.date_format(F.convert_timezone(None, F.lit(SHOP_ZONE), F.current_timestamp()), pattern)
