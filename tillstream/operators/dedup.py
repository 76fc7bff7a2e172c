"""De-duplication (DD1-DD3). DD3 is :func:`tillstream.sources.tables.latest_per_key`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.sources.tables import latest_per_key  # noqa: F401  (DD3)

# Into how many parts a key's rows are spread before the final stateful step of a stream.
SALTS = 8


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key by ``order`` (batch). Each task sends at most one row per key to the shuffle."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def row_salt(df: DataFrame, salts: int = SALTS) -> Column:
    """A salt that spreads rows of one key, from the row's content and its partition.

    It is the same when a task is repeated. Exact copies differ by partition; a topic offset among the columns tells them
    apart within a partition, too.
    """
    return F.pmod(F.xxhash64(*df.columns) + F.spark_partition_id(), F.lit(salts)).cast("int")


def dedup_stream(stream: DataFrame, keys: list[str], salts: int = SALTS, within_watermark: bool = True) -> DataFrame:
    """One row per key of a stream, the first to arrive.

    A first pass drops copies per (key, salt) in parallel, so the second pass gets at most ``salts`` rows of a key, even if
    one key or one group of copies makes up most of the stream (see :func:`row_salt`). With ``within_watermark`` a key is forgotten once the
    watermark has passed it by the delay; without it, never.
    """
    salted = stream.withColumn("_salt", row_salt(stream, salts))
    drop = "dropDuplicatesWithinWatermark" if within_watermark else "dropDuplicates"
    reduced = getattr(salted, drop)([*keys, "_salt"]) if salts > 1 else salted
    return getattr(reduced, drop)(keys).drop("_salt")
