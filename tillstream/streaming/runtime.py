"""Session settings, shared folders and running a query."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # files of a shuffle leave when its action has ended

# Settings every part of the package relies on; all can be set on a running session.
SETTINGS = {
    "spark.sql.parquet.compression.codec": "zstd",  # topics are texts, which take a third of what they do with Spark's default
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Also where the split costs a shuffle further up: it only happens where a partition is skewed.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Shuffles start from so many partitions, which adaptive execution puts together again where they are small: what a task sorts
    # does not grow with the table. State keeps to its own number (see ``stream_session``).
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "192",
}
STREAM_SETTINGS = {
    **SETTINGS,
    SHUFFLE_CLEANUP: "true",  # a micro-batch is a dozen actions; their shuffles would all stay until the driver collects garbage
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


QUERY_ID = "sql.streaming.queryId"  # Spark's name for the id of the query that runs a micro-batch


def run_of(df: DataFrame) -> str:
    """The id of the streaming query in whose micro-batch this is called; ``batch`` outside of any."""
    return df.sparkSession.sparkContext.getLocalProperty(QUERY_ID) or "batch"


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffles of the writes in this block leave the disk as soon as each has ended."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session for streaming jobs on the same cluster.

    State lives in RocksDB. Its number of partitions is fixed at a checkpoint's first batch; by default it is the number of
    cores the cluster gives the application.
    """
    session = spark.newSession()
    for name, value in STREAM_SETTINGS.items():
        session.conf.set(name, value)
    session.conf.set("spark.sql.shuffle.partitions", str(state_partitions or spark.sparkContext.defaultParallelism))
    return session


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the one the cluster names in ``spark.checkpoint.dir``.

    A temporary folder of this machine is used only where that is unset and Spark runs on this machine alone.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tillstream-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def run_to_end(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Waits for a query that ends by itself (``availableNow``); stops it and raises when the time is over."""
    ended = query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination() or True
    if not ended:
        query.stop()
        raise TimeoutError(f"query {query.name or query.id} did not end within {timeout_s} s")
    return query


def dropped_late(query: StreamingQuery) -> int:
    """Rows that the query's stateful steps dropped as too late, over the progress reports Spark still holds."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
