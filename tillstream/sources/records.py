"""JSON text to columns (SRC5, SRC6).

Change records carry numbers as text, so every field is read as text first and cast afterwards. A missing number (absent, null or
empty) becomes 0 and a missing text stays NULL. Rows without a usable key, or with a text where a number belongs, go to a second
DataFrame instead of vanishing.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Parsed(NamedTuple):
    good: DataFrame
    bad: DataFrame


def json_field(value: Column, name: str) -> Column:
    """Text of a top-level field of a JSON object; NULL when absent or when the text is no JSON."""
    return F.get_json_object(value, f"$.{name}")


def _typed(field: T.StructField, required: list[str]) -> Column:
    text = F.col(f"_record.{field.name}")
    if isinstance(field.dataType, T.StringType):
        return text.alias(field.name)
    number = text.try_cast(field.dataType)
    if field.name not in required:
        missing = text.isNull() | (F.trim(text) == "")
        number = F.when(missing, F.lit(0).cast(field.dataType)).otherwise(number)
    return number.alias(field.name)


def typed_records(
    df: DataFrame, schema: T.StructType, required: list[str], value: str = "value", keep: list[str] | None = None, times: tuple[str, ...] = ()
) -> DataFrame:
    """All records typed, with their text in ``_raw`` and whether they are usable in ``_complete`` (see :func:`parse_records`).

    For those who need good and bad ones from one pass over the texts. The record is the one element of an exploded array: a filter on
    its fields stays above that, while below a plain projection it would parse the text again for each field.
    """
    text_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    read = df.withColumn("_record", F.explode(F.array(F.from_json(F.col(value), text_schema))))
    typed = read.select(*(keep or []), F.col(value).alias("_raw"), *[_typed(f, required) for f in schema.fields])
    complete = F.lit(True)
    numbers = [f.name for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    for name in dict.fromkeys([*required, *numbers]):
        complete = complete & F.col(name).isNotNull()
    for name in times:
        complete = complete & F.try_to_timestamp(F.col(name)).isNotNull()
    return typed.withColumn("_complete", complete)


def parse_records(
    df: DataFrame,
    schema: T.StructType,
    required: list[str],
    value: str = "value",
    keep: list[str] | None = None,
    raw: str | None = None,
    times: tuple[str, ...] = (),
) -> Parsed:
    """Typed records of the JSON texts in column ``value``.

    ``required`` fields must be present, numbers castable, and ``times`` must be texts of a date and time.
    Columns named in ``keep`` are carried along, and the text itself under the name ``raw``. Works on batch and streaming
    DataFrames.
    """
    typed = typed_records(df, schema, required, value, keep, times)
    good = typed.where("_complete").drop("_complete")
    good = good.withColumnRenamed("_raw", raw) if raw else good.drop("_raw")
    return Parsed(good, typed.where("not _complete").select(F.col("_raw").alias(value)))


LATEST_MS = 253402300799999  # the last millisecond of the year 9999; a later time is no time
APP_LOG_COMMON = ["mid", "uid", "ar", "ch", "vc"]


def parse_app_log(df: DataFrame, value: str = "value", keep: list[str] | None = None, raw: str | None = None) -> Parsed:
    """App logs: ``common.*`` as a struct and ``ts`` as long; a log without device or time is bad. ``raw`` names its text."""
    schema = T.StructType(
        [
            T.StructField("common", T.StructType([T.StructField(n, T.StringType()) for n in APP_LOG_COMMON])),
            T.StructField("ts", T.StringType()),
        ]
    )
    log = F.from_json(F.col(value), schema)
    read = df.select(
        *(keep or []), F.col(value).alias("_raw"), log.getField("common").alias("common"), log.getField("ts").try_cast("long").alias("ts")
    )
    complete = F.coalesce(F.col("ts").between(0, LATEST_MS), F.lit(False)) & F.col("common.mid").isNotNull()
    good = read.where(complete)
    good = good.withColumnRenamed("_raw", raw) if raw else good.drop("_raw")
    return Parsed(good, read.where(~complete).select(F.col("_raw").alias(value)))


def carry_bad(result: DataFrame, bad: DataFrame, value: str = "value") -> DataFrame:
    """A stream's result with its bad texts in column ``_bad``, so that one query writes both."""
    return result.unionByName(bad.select(F.coalesce(F.col(value), F.lit("")).alias("_bad")), allowMissingColumns=True)


def take_bad(batch: DataFrame) -> Parsed:
    """Undoes :func:`carry_bad` on a micro-batch."""
    return Parsed(
        batch.where(F.col("_bad").isNull()).drop("_bad"), batch.where(F.col("_bad").isNotNull()).select(F.col("_bad").alias("value"))
    )
