"""Sinks (SK1-SK13, DD3).

Tables that a stream writes are upsert logs: each micro-batch of each query has its own directories ``batch_id=<n>/run=<id>``
and overwrites them when the batch is repeated, so a batch counts once however often it runs. The run is the query's id, which
its checkpoint keeps: a query with a new checkpoint counts its batches from 0 again, but leaves alone what another has written.
Every row has the time of its writing, so that readers can take the latest row per key (``sources.tables.read_dim``).
Nothing already written is rewritten by an upsert.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tillstream.schemas import DIMENSIONS, TOPIC_RECORD
from tillstream.sources.tables import BATCH, RUN, WRITTEN, latest_rows_sql, read_dim
from tillstream.streaming import manifests
from tillstream.streaming.runtime import run_of

TOPIC_ROWS = 1 << 33  # offsets of a file topic that one task has in one writing


def as_messages(df: DataFrame, topic: str, key: str | None = None) -> DataFrame:
    """Rows as topic messages: JSON of all columns, optionally with a key column (SK1, SK2, FN12)."""
    fields = [F.lit(topic).alias("topic")] + ([F.col(key).cast("string").alias("key")] if key else [])
    return df.select(*fields, F.to_json(F.struct(*df.columns)).alias("value"))


def kafka_options(servers: str, **extra: str) -> dict[str, str]:
    """Producer options; the producer is idempotent (SK3)."""
    return {"kafka.bootstrap.servers": servers, "kafka.enable.idempotence": "true", **extra}


def write_topic(messages: DataFrame, servers: str, **extra: str) -> None:
    messages.write.format("kafka").options(**kafka_options(servers, **extra)).save()


def write_topic_files(messages: DataFrame, root: str, mode: str = "append") -> None:
    """Messages as files, one directory per topic; each task writes its own files, whatever the topic sizes.

    Messages without a partition and an offset get them: the number of the task, and the number of the writing followed by that
    of the row in its task, so that the offsets of a partition grow from one writing to the next, whatever clocks say. Writings are
    counted below ``root``. Offsets have gaps; ``sources.topic_store`` gives them without.
    """
    known = {f.name: f.dataType for f in TOPIC_RECORD.fields}
    if "offset" not in messages.columns:
        row = F.monotonically_increasing_id().bitwiseAND(TOPIC_ROWS - 1)
        first = manifests.take_number(messages.sparkSession, f"{root}/_writings") * TOPIC_ROWS
        place = {"partition": F.spark_partition_id(), "offset": F.lit(first).cast("long") + row}
        messages = messages.withColumns(place)
    rows = messages.select(
        *[(F.col(c) if c in messages.columns else F.lit(None)).cast(t).alias(c) for c, t in known.items()]
    )
    rows.write.mode(mode).partitionBy("topic").parquet(root)


def stamped(df: DataFrame) -> DataFrame:
    return df.withColumn(WRITTEN, F.lit(time.time_ns() // 1_000).cast("long"))


def batch_folder(path: str, batch_id: int, run: str) -> str:
    return f"{path}/{BATCH}={batch_id}/{RUN}={run}"


def show_batch(spark: SparkSession, folder: str, path: str, batch_id: int, run: str) -> None:
    """Moves a micro-batch that is written elsewhere to its own directory of a log, by one rename; one that is there already stays.

    A stream that reads the log meets no file twice, as it could where a repeated batch overwrites its directory.
    """
    target = batch_folder(path, batch_id, run)
    if manifests.exists(spark, target):
        return
    if manifests.exists(spark, folder):
        manifests.move(spark, folder, target)
    else:
        manifests.make_folder(spark, target)  # nothing to show


def forget_batch(spark: SparkSession, path: str, batch_id: int, run: str) -> None:
    """Deletes what a micro-batch of a run has left for the next one, once that one is committed as well and cannot be repeated."""
    if batch_id >= 0:
        manifests.remove(spark, batch_folder(path, batch_id, run))


def append_batch(df: DataFrame, path: str, batch_id: int, run: str | None = None) -> None:
    """Writes a micro-batch of a run to its own directory of an upsert log (SK4, SK5, SK7, SK9)."""
    stamped(df).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}/{RUN}={run or run_of(df)}")


def append_days(df: DataFrame, path: str, batch_id: int, run: str | None = None) -> None:
    """The same for a daily index: a directory per day ``dt``, below it one per micro-batch and run (SK6, DD3).

    A reader of one day lists that day only. Rows of a day are brought together first, so that there is no file per task and
    day; Spark splits a large day over several tasks.
    """
    rows = stamped(df).withColumns({BATCH: F.lit(batch_id).cast("long"), RUN: F.lit(run or run_of(df))}).hint("rebalance", F.col("dt"))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("dt", BATCH, RUN).parquet(path)


def compact(spark: SparkSession, path: str, target: str, keys: list[str], version: list[str] | None = None) -> None:
    """Current rows of an upsert log as a new log with a single batch."""
    append_batch(read_dim(spark, path, keys, version), target, 0)


def put_document(spark: SparkSession, path: str, batch_id: int, document: str | dict, schema) -> None:
    """One document, given as JSON text or as a dict, into an index (SK7)."""
    if isinstance(document, str):
        row = spark.range(1).select(F.from_json(F.lit(document), schema).alias("d")).select("d.*")
    else:
        row = spark.createDataFrame([document], schema)
    append_batch(row, path, batch_id)


def write_jdbc(df: DataFrame, url: str, table: str, driver: str | None = None, **extra: str) -> None:
    """Appends rows over JDBC. Batch size, isolation level and number of writers are fixed values of the wide table's sink."""
    options = {"batchsize": "100", "isolationLevel": "NONE", "numPartitions": "4", **extra}
    if driver:
        options["driver"] = driver
    df.write.mode("append").options(**options).jdbc(url, table)


def write_text(df: DataFrame, path: str) -> None:
    """Rows as JSON lines, for looking at a stream's result (SK11)."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)


def to_console(stream: DataFrame, rows: int = 1000) -> DataStreamWriter:
    return stream.writeStream.format("console").option("numRows", rows).option("truncate", False)


def create_dimension(spark: SparkSession, name: str, location: str) -> None:
    """Registers the current rows of a dimension as a view over its upsert log, which has a batch at least (SK13)."""
    schema, key = DIMENSIONS[name]
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {latest_rows_sql(location, key, schema.fieldNames())}")


def each_batch(*steps: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps the micro-batch while several outputs are written from it (SK12, W7)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for step in steps:
                step(kept, batch_id)
        finally:
            kept.unpersist()

    return adaptive(run)


def adaptive(write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Lets Spark re-plan the queries of a ``foreachBatch`` function at run time, also behind stateful steps.

    The stream's own plan, for which Spark switches this off, is made before and keeps its setting.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        conf = batch.sparkSession.conf
        before = conf.get("spark.sql.adaptive.enabled")
        conf.set("spark.sql.adaptive.enabled", "true")
        try:
            write(batch, batch_id)
        finally:
            conf.set("spark.sql.adaptive.enabled", before)

    return run
