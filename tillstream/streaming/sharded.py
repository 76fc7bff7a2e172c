"""Dimensions in shards by key, of which a micro-batch reads only those that its keys are in (FN14, J3, J5).

A table is an upsert log whose batches have a directory per shard. Its number of shards is fixed by the first upsert and kept with it,
so writers and readers cannot disagree. A batch of ``k`` keys reads ``k`` shards at most, whatever the size of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.sources.tables import BATCH, RUN, WRITTEN, latest_per_key
from tillstream.streaming import manifests
from tillstream.streaming.runtime import run_of
from tillstream.streaming.sinks import stamped

SHARD = "shard"


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a key that is a whole number, also as text, as the lookups compare it; keys that are none share a shard."""
    return F.pmod(F.xxhash64(key.try_cast("long")), F.lit(shards)).cast("int")


def _shards(spark: SparkSession, path: str) -> int | None:
    return manifests.entry(spark, path, SHARD)["shards"] if SHARD in manifests.names(spark, path) else None


def upsert(rows: DataFrame, path: str, key: str, batch_id: int, shards: int, run: str | None = None) -> None:
    """Adds a batch of changed rows; a repeated batch overwrites itself. ``shards`` counts for the first batch of the table only."""
    spark = rows.sparkSession
    if _shards(spark, path) is None:
        manifests.publish(spark, path, SHARD, {"shards": shards})  # of two first writers one wins, and both read its number
    placed = stamped(rows).withColumn(SHARD, shard_of(F.col(key), _shards(spark, path)))
    files = placed.repartition(SHARD).sortWithinPartitions(SHARD, key)
    files.write.mode("overwrite").partitionBy(SHARD).parquet(f"{path}/{BATCH}={batch_id}/{RUN}={run or run_of(rows)}")


def versions_for(batch: DataFrame, batch_key: str, path: str, schema: T.StructType) -> DataFrame:
    """All versions of the rows in the shards of the batch's keys. The driver gets numbers of shards, no keys."""
    spark, shards = batch.sparkSession, _shards(batch.sparkSession, path)
    if shards is None:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(WRITTEN, T.LongType()), T.StructField(BATCH, T.LongType())]))
    wanted = [r[0] for r in batch.where(F.col(batch_key).isNotNull()).select(shard_of(F.col(batch_key), shards)).distinct().collect()]
    places = [T.StructField(WRITTEN, T.LongType()), T.StructField(BATCH, T.LongType()), T.StructField(RUN, T.StringType())]
    layout = T.StructType([*schema.fields, *places, T.StructField(SHARD, T.IntegerType())])
    return spark.read.schema(layout).parquet(path).where(F.col(SHARD).isin(wanted)).drop(SHARD, RUN)


def rows_for(batch: DataFrame, batch_key: str, path: str, schema: T.StructType, key: str) -> DataFrame:
    """Current rows of the dimension in the shards of the batch's keys: all that a lookup of the batch can find, and some more."""
    return latest_per_key(versions_for(batch, batch_key, path, schema), [key], [WRITTEN, BATCH]).drop(WRITTEN, BATCH)
