"""A topic in files with true offsets, and a streaming source over it (SRC1-SRC4).

A topic has partitions; the records of a partition have the offsets 0, 1, 2 and so on. Records are appended as Parquet files, and each append
is published by a numbered manifest that tells for every file its partition, first offset and number of records, and where each
partition ends after it. The offset of a record is its place in its file. Numbers are taken by an atomic rename, so two writers
cannot give one offset twice: the one that comes second counts again.

The source ``topic_files`` reads ranges of offsets, like the Kafka source: from the earliest, the latest, or explicit offsets on. A task reads
its part of one file. Neither data nor manifests are read on the driver beyond those of the range.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tillstream.streaming import manifests

RECORD = "topic string, partition int, offset bigint, key string, value string, timestamp timestamp"
ARROW_RECORD = pa.schema(
    [
        ("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()), ("key", pa.string()), ("value", pa.string()),
        ("timestamp", pa.timestamp("us", "UTC")),
    ]
)
BATCH_ROWS = 10_000


def append(messages: DataFrame, root: str, topic: str, partitions: int = 4, by_key: bool = False) -> dict[str, int]:
    """Appends messages (value, and key and timestamp if there are any); returns where each partition ends after it.

    Files go to the partitions in turn, or with ``by_key`` all records of a key to one, in the order of each task's rows. The
    number of partitions of a topic does not change after its first append.
    """
    spark, place = messages.sparkSession, f"{root}/{topic}"
    have = {"key": "string", "value": "string", "timestamp": "timestamp"}
    rows = messages.select(*[(F.col(c) if c in messages.columns else F.lit(None)).cast(t).alias(c) for c, t in have.items()])
    if by_key:
        rows = rows.repartition(partitions, "key")
    folder = f"data/{uuid.uuid4().hex}"
    rows.write.parquet(f"{place}/{folder}")
    name = F.col("_metadata.file_name").alias("name")
    counts = spark.read.schema("value string").parquet(f"{place}/{folder}").groupBy(name).count().orderBy("name").collect()
    while True:
        known = manifests.names(spark, place)
        last = manifests.entry(spark, place, known[-1]) if known else {"ends": {str(p): 0 for p in range(partitions)}}
        ends = dict(last["ends"])
        if len(ends) != partitions:
            raise ValueError(f"topic {topic} has {len(ends)} partitions")
        begins, segments = dict(ends), []
        turn = sum(ends.values())
        for i, row in enumerate(counts):
            p = str(int(row["name"].split("-")[1]) % partitions if by_key else (turn + i) % partitions)
            segments.append({"file": f"{folder}/{row['name']}", "partition": int(p), "start": ends[p], "count": row["count"]})
            ends[p] += row["count"]
        if manifests.publish(spark, place, f"{len(known):012d}", {"begins": begins, "ends": ends, "segments": segments}):
            return ends


@dataclass
class Part(InputPartition):
    """Rows ``low`` to ``high`` of a file; the first row of the file has offset ``start``."""

    file: str
    partition: int
    start: int
    low: int
    high: int

    def __init__(self, file: str, partition: int, start: int, low: int, high: int):
        super().__init__(None)
        self.file, self.partition, self.start, self.low, self.high = file, partition, start, low, high


class _Store:
    """Reads manifests and files of a topic, without a session: on the driver for offsets, in tasks for records."""

    def __init__(self, options: dict):
        options = {name.lower(): value for name, value in options.items()}  # Spark hands them on in small letters
        self.topic = options["topic"]
        self.place = f"{options['path'].rstrip('/')}/{self.topic}"
        self.begin = options.get("startingoffsets", "latest")

    def _open(self) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(self.place)

    def _names(self) -> list[str]:
        system, base = self._open()
        found = system.get_file_info(pafs.FileSelector(f"{base}/{manifests.FOLDER}", allow_not_found=True))
        return sorted(i.base_name for i in found if i.base_name.endswith(".json") and not i.base_name.startswith("."))

    def _entry(self, name: str) -> dict:
        system, base = self._open()
        with system.open_input_stream(f"{base}/{manifests.FOLDER}/{name}") as f:
            return json.loads(f.read())

    def ends(self) -> dict[str, int]:
        known = self._names()
        return dict(sorted(self._entry(known[-1])["ends"].items())) if known else {}

    def first(self) -> dict[str, int]:
        ends = self.ends()
        if self.begin == "latest":
            return ends
        given = {} if self.begin == "earliest" else {str(p): int(n) for p, n in json.loads(self.begin).items()}
        beyond = {p: n for p, n in given.items() if n > ends.get(p, 0)}
        if beyond:
            raise ValueError(f"topic {self.topic} ends before the offsets {beyond}")
        return dict(sorted({**{p: 0 for p in ends}, **given}.items()))

    def parts(self, start: dict[str, int], end: dict[str, int]) -> list[Part]:
        """The rows of files in the range; manifests are read from the last one back to the range's start."""
        found: list[Part] = []
        for name in reversed(self._names()):
            entry = self._entry(name)
            for s in entry["segments"]:
                p = str(s["partition"])
                low, high = max(start.get(p, 0) - s["start"], 0), min(end.get(p, 0) - s["start"], s["count"])
                if low < high:
                    found.append(Part(s["file"], s["partition"], s["start"], low, high))
            if all(n <= start.get(p, 0) for p, n in entry["begins"].items()):
                break
        return found

    def records(self, part: Part) -> Iterator[pa.RecordBatch]:
        system, base = self._open()
        at = 0
        with system.open_input_file(f"{base}/{part.file}") as source:
            for batch in pq.ParquetFile(source).iter_batches(BATCH_ROWS, columns=["key", "value", "timestamp"]):
                low, high = max(part.low - at, 0), min(part.high - at, batch.num_rows)
                if low < high:
                    rows, n = batch.slice(low, high - low), high - low
                    first = part.start + at + low
                    columns = [
                        pa.array([self.topic] * n), pa.array([part.partition] * n, pa.int32()), pa.array(range(first, first + n), pa.int64()),
                        *[rows.column(f.name).cast(f.type) for f in list(ARROW_RECORD)[3:]],
                    ]
                    yield pa.RecordBatch.from_arrays(columns, schema=ARROW_RECORD)
                at += batch.num_rows
                if at >= part.high:
                    break


class TopicStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.store = _Store(options)

    def initialOffset(self) -> dict:
        return self.store.first()

    def latestOffset(self) -> dict:
        return self.store.ends()

    def partitions(self, start: dict, end: dict) -> list[Part]:
        return self.store.parts(start, end)

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        return self.store.records(partition)


class TopicReader(DataSourceReader):
    """All records from the starting offsets to the ends at the time of planning."""

    def __init__(self, options: dict):
        self.store = _Store({"startingoffsets": "earliest", **options})

    def partitions(self) -> list[Part]:
        return self.store.parts(self.store.first(), self.store.ends()) or [Part("", 0, 0, 0, 0)]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        return self.store.records(partition) if partition.file else iter(())


class TopicFiles(DataSource):
    """``spark.readStream.format("topic_files")`` with the options path, topic and startingOffsets."""

    @classmethod
    def name(cls) -> str:
        return "topic_files"

    def schema(self) -> str:
        return RECORD

    def reader(self, schema) -> TopicReader:
        return TopicReader(dict(self.options))

    def streamReader(self, schema) -> TopicStreamReader:
        return TopicStreamReader(dict(self.options))


def _register(spark: SparkSession) -> None:
    spark.createDataFrame([], "x int")  # makes this session the active one, whose names the registration compares
    spark.dataSource.register(TopicFiles)


def open_topic(spark: SparkSession, root: str, topic: str, offsets: dict[int, int] | str = "latest") -> DataFrame:
    """A stream of a topic's records from offsets on, as ``topics.open_stream`` gives for Kafka: stored ones, or the latest (SRC4)."""
    _register(spark)
    begin = offsets if isinstance(offsets, str) else json.dumps({str(p): n for p, n in offsets.items()}) if offsets else "latest"
    return spark.readStream.format("topic_files").options(path=root, topic=topic, startingOffsets=begin).load()


def read_topic(spark: SparkSession, root: str, topic: str, begin: str = "earliest") -> DataFrame:
    """The records there are now, as a batch."""
    _register(spark)
    return spark.read.format("topic_files").options(path=root, topic=topic, startingOffsets=begin).load()
