"""Sales statistics (AG1-AG3, AG6, W5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions.clock import hour_of, padded_hour
from tillstream.functions.money import from_cents


def trademark_sales(pairs: DataFrame) -> DataFrame:
    """Allocated amount per brand. Brands are grouped by id and name, so any name is kept as it is."""
    return pairs.groupBy("tm_id", "tm_name").agg(from_cents(F.sum("final_detail_c")).alias("amount"))


def day_total(pairs: DataFrame, day: str) -> DataFrame:
    """Allocated amount of a day; NULL if there is none, as a sum over no rows."""
    return pairs.where(F.col("dt") == day).agg(from_cents(F.sum("final_detail_c")).alias("sum_amount"))


def sales_by_hour(pairs: DataFrame, day: str) -> DataFrame:
    """Allocated amount per hour of a day, hours padded to two digits."""
    hour = padded_hour(hour_of(F.col("create_time"))).alias("hr")
    return pairs.where(F.col("dt") == day).groupBy(hour).agg(from_cents(F.sum("final_detail_c")).alias("am"))


def as_map(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Rows as one map in key order. Meant for the results per hour, which have 24 rows at most."""
    return rows.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(key, value)))).alias("result"))


def sliding_sums(rows: DataFrame, time: str, value: str, length_s: int = 20, slide_s: int = 5) -> DataFrame:
    """Sum and count of ``value`` in sliding windows (batch).

    Rows are added up once per slide first; each of these small sums then goes into the windows it belongs to.
    """
    if length_s % slide_s:
        raise ValueError("the window length must be a multiple of the slide")
    pane = F.window(time, f"{slide_s} seconds").getField("start")
    panes = rows.groupBy(pane.alias("_pane")).agg(F.sum(value).alias("_sum"), F.count(F.lit(1)).alias("_n"))
    back = F.explode(F.sequence(F.lit(0), F.lit(length_s - slide_s), F.lit(slide_s)))
    starts = panes.withColumn("_back", back)
    start = F.col("_pane") - F.make_dt_interval(secs=F.col("_back").cast("decimal(18,6)"))
    windows = starts.groupBy(start.alias("window_start")).agg(F.sum("_sum").alias("amount"), F.sum("_n").alias("n"))
    return windows.withColumn("window_end", F.col("window_start") + F.make_dt_interval(secs=F.lit(length_s)))


def sliding_sums_stream(rows: DataFrame, time: str, value: str, lateness: str, length_s: int = 20, slide_s: int = 5) -> DataFrame:
    """The same on a stream; a window comes out once the watermark has passed its end."""
    window = F.window(time, f"{length_s} seconds", f"{slide_s} seconds")
    sums = rows.withWatermark(time, lateness).groupBy(window).agg(F.sum(value).alias("amount"), F.count(F.lit(1)).alias("n"))
    return sums.select(F.col("window.start").alias("window_start"), "amount", "n", F.col("window.end").alias("window_end"))
