"""Dimensions in shards by key."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tillstream.operators import lookups
from tillstream.streaming import sharded
from tillstream.streaming.runtime import shared_folder

LAYOUT = "id string, age_group string, gender string"


@pytest.fixture
def path(spark):
    return shared_folder(spark, "sharded")


def people(spark, n, age):
    return spark.range(n).select(F.col("id").cast("string").alias("id"), F.lit(age).alias("age_group"), F.lit("F").alias("gender"))


def batch(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "user_id long")


def test_reads_grow_with_the_batch(spark, path):
    schema = people(spark, 0, "").schema
    sharded.upsert(people(spark, 4000, "old"), path, "id", 0, 64)
    sharded.upsert(people(spark, 4000, "new").where("id < 2000"), path, "id", 1, 8)  # the first number of shards stays
    few = sharded.versions_for(batch(spark, 7, 7, 3000), "user_id", path, schema)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard" in plan or "PartitionFilters: [shard" in plan, plan
    assert 0 < few.count() <= 2 * 6000 / 64 * 1.6
    joined = lookups.with_user(batch(spark, 7, 3000, 9999), sharded.rows_for(batch(spark, 7, 3000, 9999), "user_id", path, schema, "id"))
    assert sorted((r["user_id"], r["user_age_group"]) for r in joined.collect()) == [(7, "new"), (3000, "old"), (9999, None)]


def test_a_repeated_batch_counts_once(spark, path):
    schema = people(spark, 0, "").schema
    for _ in range(2):
        sharded.upsert(people(spark, 10, "a"), path, "id", 0, 4)
    assert sharded.versions_for(batch(spark, *range(10)), "user_id", path, schema).count() == 10


def test_no_keys_and_no_table(spark, path):
    schema = people(spark, 0, "").schema
    assert sharded.rows_for(batch(spark, 1), "user_id", path, schema, "id").count() == 0
    sharded.upsert(people(spark, 10, "a").union(spark.createDataFrame([(None, "x", "M"), ("one", "y", "M")], LAYOUT)), path, "id", 0, 4)
    assert sharded.rows_for(batch(spark, None), "user_id", path, schema, "id").count() == 0
    assert sharded.rows_for(batch(spark), "user_id", path, schema, "id").count() == 0
