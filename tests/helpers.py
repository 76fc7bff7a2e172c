"""Small helpers for the tests."""

import json

from pyspark.sql import functions as F

from tillstream.schemas import TOPIC_RECORD
from tillstream.streaming import jobs
from tillstream.streaming.runtime import run_to_end


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))


def send(spark, root, topic, records, start_offset=0):
    """Adds records (dicts or texts) to a topic as one file, so that they make up one micro-batch of a running job."""
    data = [
        (0, start_offset + i, None, r if isinstance(r, str) or r is None else json.dumps(r), None)
        for i, r in enumerate(records)
    ]
    kinds = {f.name: f.dataType.simpleString() for f in TOPIC_RECORD.fields if f.name != "topic"}
    schema = ", ".join(f"`{name}` {kind}" for name, kind in kinds.items())
    frame = spark.createDataFrame(data, schema).coalesce(1)
    frame.withColumn("topic", F.lit(topic)).write.mode("append").partitionBy("topic").parquet(root)


def run(writer, checkpoint):
    """Runs a job until it has read everything; returns the finished query."""
    return run_to_end(jobs.start(writer, str(checkpoint), available_now=True), timeout_s=120)
