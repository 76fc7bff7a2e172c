"""Table sources (SRC7-SRC9): dimension store, relational store, daily index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "batch_id"
RUN = "run"  # the query that wrote a batch
WRITTEN = "written_us"  # when it did


def latest_per_key(df: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """One row per key, the one with the highest version columns (DD3).

    Spark plans ``row_number() = 1`` with a group limit before the shuffle, so each task sends one row per key however many
    versions a key has.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in version])
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def read_log(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All rows of an upsert log (``streaming.sinks.append_batch``), with the writing batch in ``batch_id`` and the time of it."""
    reader = spark.read
    if schema is not None:
        places = [T.StructField(WRITTEN, T.LongType()), T.StructField(BATCH, T.LongType()), T.StructField(RUN, T.StringType())]
        reader = reader.schema(T.StructType(schema.fields + places))
    return reader.parquet(path).withColumn(BATCH, F.col(BATCH).cast("long")).drop(RUN)


def latest_rows_sql(path: str, key: str, columns: list[str]) -> str:
    """The query of :func:`read_dim` as SQL."""
    newest = f"row_number() OVER (PARTITION BY {key} ORDER BY {WRITTEN} DESC, {BATCH} DESC)"
    return f"SELECT {', '.join(columns)} FROM (SELECT *, {newest} AS _rank FROM parquet.`{path}`) WHERE _rank = 1"


def read_dim(spark: SparkSession, path: str, keys: list[str], version: list[str] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Current rows of a dimension table: the last written row per key. Column names match in any letter case."""
    rows = read_log(spark, path, schema)
    return latest_per_key(rows, keys, [WRITTEN, BATCH, *(version or [])]).drop(WRITTEN, BATCH)


def read_day(spark: SparkSession, path: str, day: str, keys: list[str] | None = None, version: list[str] | None = None) -> DataFrame:
    """One day of a daily index (``streaming.sinks.append_days``). Only that day's directory is listed and read."""
    rows = spark.read.option("basePath", path).parquet(f"{path}/dt={day}").withColumn("dt", F.lit(day))
    current = latest_per_key(rows, keys, [WRITTEN, BATCH, *(version or [])]) if keys else rows
    return current.drop(WRITTEN, BATCH, RUN)


def read_days(spark: SparkSession, path: str, days: DataFrame) -> DataFrame:
    """The rows of a daily index on the days (column ``dt``) that another table gives.

    Where Spark finds those days few, it has them before it lists the index's files, and reads their directories only.
    """
    wanted = days.select(F.col("dt").cast("date").alias("dt")).distinct()
    return spark.read.parquet(path).join(wanted, "dt", "left_semi").withColumn("dt", F.col("dt").cast("string")).drop(WRITTEN, BATCH, RUN)


def read_sql(spark: SparkSession, url: str, query: str, driver: str | None = None, **options: str) -> DataFrame:
    """Result of a SQL query on a relational store, over JDBC."""
    reader = spark.read.format("jdbc").option("url", url).option("query", query).options(**options)
    return (reader.option("driver", driver) if driver else reader).load()
