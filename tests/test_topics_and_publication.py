"""Topics with true offsets, and results published together with their offsets."""

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from helpers import rows, run
from tillstream.sources import topic_store
from tillstream.sources.topic_store import append, open_topic, read_topic
from tillstream.streaming import jobs, manifests
from tillstream.streaming.progress import batch_offsets
from tillstream.streaming.runtime import shared_folder, stream_session
from tillstream.streaming.sinks import append_batch


@pytest.fixture
def session(spark):
    return stream_session(spark, 4)


@pytest.fixture
def root(spark):
    return shared_folder(spark, "topics")


def numbers(spark, low, high):
    return spark.range(low, high, numPartitions=3).select(F.col("id").cast("string").alias("value"), (F.col("id") % 5).cast("string").alias("key"))


def test_offsets_are_places_in_partitions(spark, root):
    for low, high in ((0, 50), (50, 51), (51, 51), (51, 90)):
        ends = append(numbers(spark, low, high), root, "t", partitions=2)
    got = read_topic(spark, root, "t").select("partition", "offset", "value").collect()
    assert sorted(int(r.value) for r in got) == list(range(90))
    for p in (0, 1):
        assert sorted(r.offset for r in got if r.partition == p) == list(range(ends[str(p)]))
    later = read_topic(spark, root, "t", json.dumps({"0": ends["0"], "1": ends["1"] - 3})).collect()
    assert sorted((r.partition, r.offset) for r in later) == [(1, ends["1"] - k) for k in (3, 2, 1)]
    assert read_topic(spark, root, "t", "latest").count() == 0
    assert read_topic(spark, root, "absent").count() == 0
    with pytest.raises(ValueError):
        append(numbers(spark, 0, 1), root, "t", partitions=3)


def test_keys_stay_in_their_partition(spark, root):
    for low in (0, 40):
        append(numbers(spark, low, low + 40), root, "t", by_key=True)
    got = read_topic(spark, root, "t").select("key", "partition").distinct().collect()
    assert len(got) == 5


def test_two_writers_take_different_offsets(spark, root, monkeypatch):
    append(numbers(spark, 0, 5), root, "t", partitions=1)
    real, late = manifests.publish, []

    def publish(*args):
        if not late:
            late.append(True)
            append(numbers(spark, 5, 9), root, "t", partitions=1)  # another writer is faster
        return real(*args)

    monkeypatch.setattr(manifests, "publish", publish)
    append(numbers(spark, 9, 12), root, "t", partitions=1)
    got = read_topic(spark, root, "t")
    assert sorted(r.offset for r in got.collect()) == list(range(12)) and got.select("value").distinct().count() == 12


def copy(stream, path):
    def write(batch, batch_id):
        append_batch(batch.select("partition", "offset", "value"), path, batch_id)

    return stream.writeStream.foreachBatch(write)


def test_starts(spark, session, root):
    append(numbers(spark, 0, 20), root, "t", partitions=2)
    first = run(copy(open_topic(session, root, "t", "earliest"), f"{root}/all"), f"{root}/c1")
    run(copy(open_topic(session, root, "t", "latest"), f"{root}/new"), f"{root}/c2")
    ends = json.loads(first.recentProgress[-1].json)["sources"][0]["endOffset"]
    ends = json.loads(ends) if isinstance(ends, str) else ends
    run(copy(open_topic(session, root, "t", {0: 2, 1: int(ends["1"])}), f"{root}/some"), f"{root}/c3")
    append(numbers(spark, 20, 30), root, "t", partitions=2)
    for name, checkpoint in (("all", "c1"), ("new", "c2"), ("some", "c3")):  # the checkpoint counts, not the option
        run(copy(open_topic(session, root, "t", "earliest"), f"{root}/{name}"), f"{root}/{checkpoint}")
    values = lambda name: sorted(int(r.value) for r in spark.read.parquet(f"{root}/{name}").collect())
    assert values("all") == list(range(30)) and values("new") == list(range(20, 30))
    got = spark.read.parquet(f"{root}/some")
    assert got.where("partition = 0").agg(F.min("offset")).first()[0] == 2
    assert got.count() == 30 - 2 - int(ends["1"]) and got.count() == got.distinct().count()


def test_a_range_reads_only_its_manifests(spark, root, monkeypatch):
    for k in range(5):
        append(numbers(spark, 10 * k, 10 * k + 10).coalesce(1), root, "t", partitions=1)
    store = topic_store._Store({"path": root, "topic": "t"})
    read, real = [], store._entry
    monkeypatch.setattr(store, "_entry", lambda name: read.append(name) or real(name))
    assert [(p.start, p.low, p.high) for p in store.parts({"0": 35}, {"0": 42})] == [(40, 0, 2), (30, 5, 10)]
    assert len(read) == 2


def test_manifests_are_whole_and_once(spark, root):
    assert manifests.names(spark, root) == []
    assert manifests.publish(spark, root, "a", {"x": 1}) and not manifests.publish(spark, root, "a", {"x": 2})
    assert manifests.names(spark, root) == ["a"] and manifests.entry(spark, root, "a") == {"x": 1}


WIDE = {"tm_id": 1, "tm_name": "A", "order_id": 1, "final_detail_amount": 1.5}


def test_results_and_offsets_appear_together(spark, session, root):
    wide = lambda *amounts: spark.createDataFrame([(json.dumps({**WIDE, "final_detail_amount": a}),) for a in amounts], "value string")
    append(wide(1.5, 2.25, "no number"), root, "wide", partitions=2)

    def job(before=None, offsets="earliest"):
        return jobs.published_trademark_stats(open_topic(session, root, "wide", offsets), "g", f"{root}/out", before)

    run(job(), f"{root}/c")
    stats = lambda: rows(manifests.read_published(spark, f"{root}/out", "stats", jobs.STATS), "trademark_id", "amount")
    covered = lambda: manifests.published_offsets(spark, f"{root}/out", "wide", "g")
    assert stats() == [("1", 3.75)] and sum(covered().values()) == 3
    assert manifests.read_published(spark, f"{root}/out", "bad", "value string").count() == 1
    before = covered()
    append(wide(10.0), root, "wide", partitions=2)

    def killed():
        raise RuntimeError("killed between the writes")

    with pytest.raises(StreamingQueryException):
        run(job(killed), f"{root}/c")
    assert stats() == [("1", 3.75)] and covered() == before
    run(job(), f"{root}/c")  # the batch is repeated
    assert stats() == [("1", 10.0), ("1", 3.75)] and sum(covered().values()) == 4
    append(wide(20.0, 30.0), root, "wide", partitions=2)
    run(job(offsets=covered()), f"{root}/without-the-old-checkpoint")
    assert sorted(a for _, a in stats()) == [3.75, 10.0, 50.0] and sum(covered().values()) == 6


def test_a_published_batch_is_left_alone(spark, root):
    frame = spark.createDataFrame([("t", 0, 4)], "topic string, partition int, offset long")
    batch = {"x": spark.range(3)}
    assert manifests.publish_batch(spark, root, 7, batch, batch_offsets(frame, "g"), "r")
    assert not manifests.publish_batch(spark, root, 7, {"x": spark.range(5)}, batch_offsets(frame, "g"), "r")
    assert manifests.read_published(spark, root, "x", "id long").count() == 3
    assert manifests.published_offsets(spark, root, "t", "g") == {0: 5}
    assert manifests.published_offsets(spark, root, "t", "other") == {} == manifests.published_offsets(spark, f"{root}/none", "t", "g")
