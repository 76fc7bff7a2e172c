"""Progress and delivery (PR1-PR7).

A query's checkpoint holds its offsets (written before a batch) and commits (after its output). Outputs are keyed by query
and batch id, so a batch that is repeated after a failure replaces what it had written, and nothing else. The ledger is a readable copy of the offsets
next to the results, from which a new query can start without the old checkpoint.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tillstream.sources.tables import read_log
from tillstream.streaming import manifests
from tillstream.streaming.sinks import append_batch


def checkpoint_path(root: str, group: str, *topics: str) -> str:
    """One checkpoint per consumer group and topics (PR1-PR3)."""
    return f"{root}/checkpoints/{group}/{'-'.join(topics)}"


def batch_offsets(records: DataFrame, group: str) -> DataFrame:
    """Next offset per topic and partition after these records (PR5): one row per partition."""
    ends = records.groupBy("topic", F.col("partition").alias("partition_id")).agg(
        (F.max("offset") + 1).alias("topic_offset")
    )
    return ends.select(F.lit(group).alias("group_id"), "topic", "partition_id", "topic_offset")


def save_offsets(records: DataFrame, group: str, path: str, batch_id: int) -> None:
    append_batch(batch_offsets(records, group), path, batch_id)


def latest_offsets(ledger: DataFrame) -> DataFrame:
    """Furthest saved offset per group, topic and partition: batches of several runs have no common order, offsets have."""
    return ledger.groupBy("group_id", "topic", "partition_id").agg(F.max("topic_offset").alias("topic_offset"))


def read_offsets(spark: SparkSession, path: str, topic: str, group: str) -> dict[int, int]:
    """Saved offsets of a topic and group, for ``sources.topics.Topic`` (PR4). One entry per topic partition."""
    rows = latest_offsets(read_log(spark, path)).where((F.col("topic") == topic) & (F.col("group_id") == group))
    return {r["partition_id"]: r["topic_offset"] for r in rows.select("partition_id", "topic_offset").collect()}


def offset_ranges(query: StreamingQuery) -> list[tuple[int, dict, dict]]:
    """(batch id, start offsets, end offsets) of the last micro-batches, per source description (PR6).

    The start of a source's first batch is None.
    """
    reports = [json.loads(p.json) for p in query.recentProgress]
    return [
        (
            r["batchId"],
            {s["description"]: s["startOffset"] for s in r["sources"]},
            {s["description"]: s["endOffset"] for s in r["sources"]},
        )
        for r in reports
    ]


class RangeLedger(StreamingQueryListener):
    """Publishes the offset ranges of every micro-batch of the session's queries below ``path`` (PR6), however many there are.

    ``session.streams.addListener(RangeLedger(session, path))``. An entry is published once, under the query's id and the batch.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = json.loads(event.progress.json)
        ranges = [{"source": s["description"], "start": _text(s["startOffset"]), "end": _text(s["endOffset"])} for s in report["sources"]]
        entry = {"query": report["name"], "batch_id": report["batchId"], "rows": report["numInputRows"], "ranges": ranges}
        manifests.publish(self.spark, self.path, f"{report['id']}.{report['batchId']:012d}", entry)


def _text(offset) -> str | None:
    return offset if offset is None or isinstance(offset, str) else json.dumps(offset, sort_keys=True)


def read_ranges(spark: SparkSession, path: str) -> DataFrame:
    """A row per micro-batch, source and partition: query, batch_id, source, partition_id, begin_offset, end_offset. An absent begin is 0."""
    layout = "query string, batch_id long, ranges array<struct<source: string, start: string, end: string>>"
    rows = spark.read.schema(layout).json(f"{path}/{manifests.FOLDER}").select("query", "batch_id", F.explode("ranges").alias("r"))
    offsets = "map<string, bigint>"
    rows = rows.select("query", "batch_id", "r.source", F.from_json("r.start", offsets).alias("start"), F.explode(F.from_json("r.end", offsets)).alias("p", "e"))
    begin = F.coalesce(F.col("start")[F.col("p")], F.lit(0).cast("long")).alias("begin_offset")
    return rows.select("query", "batch_id", "source", F.col("p").cast("int").alias("partition_id"), begin, F.col("e").alias("end_offset"))
