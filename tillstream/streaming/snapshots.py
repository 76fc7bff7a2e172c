"""Snapshot tables: upserts, compaction in place, and lookups by key without a shuffle of the table (SK4, SK13, SRC7).

A table is a base and the changes since. The base is bucketed and sorted by key; an upsert adds a folder of changed rows. Numbered
manifests say what there is: readers take the last base and the changes that came after it, so a compaction writes beside
them and then shows its base at once. While there are no changes, reading a table is reading its base, and a join on the key uses the buckets.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.sources.tables import latest_per_key
from tillstream.streaming import manifests

CHANGE = "_change"  # number of the manifest that a row came with


def _history(spark: SparkSession, root: str) -> list[tuple[int, dict]]:
    return [(int(n), manifests.entry(spark, root, n)) for n in manifests.names(spark, root)]


def _publish_next(spark: SparkSession, root: str, entry: dict) -> int:
    while True:
        number = len(manifests.names(spark, root))
        if manifests.publish(spark, root, f"{number:012d}", entry):
            return number


def _current(history: list[tuple[int, dict]]) -> tuple[dict | None, list[tuple[int, dict]]]:
    """The last base and the changes that it does not cover."""
    bases = [e for _, e in history if e["kind"] == "base"]
    covered = bases[-1]["covers"] if bases else -1
    return (bases[-1] if bases else None), [(n, e) for n, e in history if e["kind"] == "changes" and n > covered]


def upsert(rows: DataFrame, root: str) -> int:
    """Adds changed rows; of several with one key in different upserts the last upsert's counts. Keys are unique within one."""
    spark, folder = rows.sparkSession, f"changes/{uuid.uuid4().hex}"
    rows.write.parquet(f"{root}/{folder}")
    return _publish_next(spark, root, {"kind": "changes", "folder": folder})


def _base(spark: SparkSession, root: str, base: dict, schema: T.StructType) -> DataFrame:
    """The base as a bucketed table of this session's catalog, which is made where it is not known yet."""
    name = f"snapshot_{base['folder'].rpartition('/')[2]}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{base['key']}`) SORTED BY (`{base['key']}`) "
            f"INTO {base['buckets']} BUCKETS LOCATION '{root}/{base['folder']}'"
        )
    return spark.table(name)


def read_snapshot(spark: SparkSession, root: str, schema: T.StructType, key: str) -> DataFrame:
    """The table's rows as of now."""
    base, changes = _current(_history(spark, root))
    if not changes:
        return _base(spark, root, base, schema) if base else spark.createDataFrame([], schema)
    parts = [spark.read.schema(schema).parquet(f"{root}/{e['folder']}").withColumn(CHANGE, F.lit(n)) for n, e in changes]
    if base:
        parts.append(_base(spark, root, base, schema).withColumn(CHANGE, F.lit(-1)))
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    return latest_per_key(rows, [key], [CHANGE]).drop(CHANGE)


def compact(spark: SparkSession, root: str, schema: T.StructType, key: str, buckets: int) -> None:
    """Makes the rows of now the new base. Upserts that come meanwhile stay changes; readers never see a state between."""
    history = _history(spark, root)
    if not history or (not _current(history)[1]):
        return
    covers, folder = history[-1][0], f"base/{uuid.uuid4().hex}"
    rows = read_snapshot(spark, root, schema, key).repartition(buckets, key)
    name = f"snapshot_{folder.rpartition('/')[2]}"
    rows.write.bucketBy(buckets, key).sortBy(key).option("path", f"{root}/{folder}").saveAsTable(name)
    _publish_next(spark, root, {"kind": "base", "folder": folder, "key": key, "buckets": buckets, "covers": covers})


def create_view(spark: SparkSession, name: str, root: str, schema: T.StructType, key: str) -> None:
    """A name by which SQL reads the table; made anew after an upsert or a compaction (SK13)."""
    read_snapshot(spark, root, schema, key).createOrReplaceTempView(name)
