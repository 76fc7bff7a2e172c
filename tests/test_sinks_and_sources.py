import json

from pyspark.sql import functions as F

from helpers import rows
from tillstream.schemas import DIMENSIONS, USER_INFO
from tillstream.sources.tables import read_day, read_dim, read_log
from tillstream.sources.topics import Topic, starting_offsets, topic_options
from tillstream.streaming import sinks
from tillstream.streaming.progress import checkpoint_path, latest_offsets
from tillstream.streaming.runtime import shared_folder


def test_topic_options():
    assert topic_options(Topic("t", "h:1"))["startingOffsets"] == "latest"
    options = topic_options(Topic("t", "h:1", group="g", offsets={1: 7}, partitions=4))
    assert json.loads(options["startingOffsets"]) == {"t": {"0": -2, "1": 7, "2": -2, "3": -2}}
    assert options["kafka.group.id"] == "g"
    assert json.loads(starting_offsets("t", {2: 5})) == {"t": {"0": -2, "1": -2, "2": 5}}
    assert sinks.kafka_options("h:1")["kafka.enable.idempotence"] == "true"
    assert checkpoint_path("/r", "g", "a", "b") == "/r/checkpoints/g/a-b"


def test_messages(spark):
    df = spark.createDataFrame([(1, "x", None)], "id long, name string, none string")
    row = sinks.as_messages(df, "t", "id").first()
    assert (row.topic, row.key, row.value) == ("t", "1", '{"id":1,"name":"x"}')
    assert sinks.as_messages(df, "t").columns == ["topic", "value"]


def test_upsert_log(spark):
    root = shared_folder(spark, "log")
    frame = lambda data: spark.createDataFrame(data, "id string, name string")
    sinks.append_batch(frame([("1", "a"), ("2", "b")]), f"{root}/dim", 0)
    sinks.append_batch(frame([("1", "wrong")]), f"{root}/dim", 1)
    sinks.append_batch(frame([("1", "c"), ("3", "d")]), f"{root}/dim", 1)  # batch 1 again
    want = [("1", "c"), ("2", "b"), ("3", "d")]
    assert rows(read_dim(spark, f"{root}/dim", ["id"])) == want
    sinks.compact(spark, f"{root}/dim", f"{root}/small", ["id"])
    assert rows(read_dim(spark, f"{root}/small", ["ID"])) == want
    assert read_log(spark, f"{root}/small").count() == 3


def test_daily_index(spark):
    root = shared_folder(spark, "days")
    frame = lambda data: spark.createDataFrame(data, "mid string, ts long, dt string")
    sinks.append_days(frame([("1", 1, "2024-01-01"), ("2", 1, "2024-01-02")]), root, 0)
    for _ in range(2):
        sinks.append_days(frame([("1", 2, "2024-01-01")]), root, 1)
    assert rows(read_day(spark, root, "2024-01-01", ["mid"]), "mid", "ts", "dt") == [("1", 2, "2024-01-01")]
    assert read_day(spark, root, "2024-01-01").count() == 2
    files = read_day(spark, root, "2024-01-02").inputFiles()
    assert files and all("dt=2024-01-02" in f for f in files)


def test_single_documents(spark):
    root = shared_folder(spark, "documents")
    schema = "id long, name string, doubanScore float, actorList array<struct<id:long,name:string>>"
    text = '{"id": 200, "name": "river", "doubanScore": 8.0, "actorList": [{"id": 3, "name": "z"}]}'
    sinks.put_document(spark, root, 0, text, schema)
    sinks.put_document(spark, root, 1, {"id": 300, "name": "sky", "doubanScore": 9.0, "actorList": [{"id": 1, "name": "y"}]}, schema)
    got = read_dim(spark, root, ["id"])
    assert rows(got, "id", "name", "doubanScore") == [(200, "river", 8.0), (300, "sky", 9.0)]


def test_create_dimension(spark):
    root = shared_folder(spark, "tables")
    schema, key = DIMENSIONS["user_info"]
    assert schema == USER_INFO and key == "id"
    user = lambda age: spark.createDataFrame([("1", "a", "b", "F", age, "female")], schema)
    sinks.append_batch(user("20-29"), root, 0)
    sinks.create_dimension(spark, "user_info", root)
    assert rows(spark.table("user_info"), "id", "age_group") == [("1", "20-29")]
    sinks.append_batch(user("30-39"), root, 1)
    sinks.append_batch(user("40+"), root, 0, run="another")
    assert rows(spark.table("user_info"), "id", "age_group") == [("1", "40+")]
    spark.sql("DROP VIEW user_info")


def test_text_dump(spark):
    root = shared_folder(spark, "text")
    sinks.write_text(spark.range(2), root)
    assert sorted(r.value for r in spark.read.text(root).collect()) == ['{"id":0}', '{"id":1}']


def test_ledger_keeps_the_last_batch(spark):
    ledger = spark.createDataFrame(
        [("g", "t", 0, 5, 0), ("g", "t", 0, 9, 1), ("g", "t", 1, 3, 0), ("h", "t", 0, 1, 4)],
        "group_id string, topic string, partition_id int, topic_offset long, batch_id long",
    )
    got = rows(latest_offsets(ledger), "group_id", "partition_id", "topic_offset")
    assert got == [("g", 0, 9), ("g", 1, 3), ("h", 0, 1)]


def test_each_batch_keeps_and_releases(spark):
    seen = []
    run = sinks.each_batch(lambda b, i: seen.append((b.is_cached, b.count(), i)), lambda b, i: seen.append(i))
    frame = spark.range(5).withColumn("x", F.lit(1))
    run(frame, 3)
    assert seen == [(True, 5, 3), 3] and not frame.is_cached


def test_offsets_of_file_topics_grow_without_a_clock(spark, monkeypatch):
    root, last = shared_folder(spark, "file-topic"), -1
    for now in (3_000, 2_000, 1_000):
        monkeypatch.setattr(sinks.time, "time_ns", lambda now=now: now)
        sinks.write_topic_files(spark.range(50).select(F.lit("t").alias("topic"), F.col("id").cast("string").alias("value")), root)
        found = [r.offset for r in spark.read.parquet(f"{root}/topic=t").where("partition = 0").collect()]
        assert len(set(found)) == len(found) and sum(o > last for o in found) == 50 // spark.sparkContext.defaultParallelism
        last = max(found)
