"""Manifests: small files whose appearance publishes what was written before them (SK9, PR5).

Data folders are written first, where no reader looks. A manifest that names them is then written under a hidden name and renamed; the
rename is atomic and fails if the name is taken, so a manifest is there as a whole or not at all, and only once. Readers follow
manifests only: a writer that ends half-way leaves folders that nobody sees.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.streaming.runtime import run_of

FOLDER = "_manifests"


def _file_context(spark: SparkSession, folder: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(folder)
    conf = spark._jsc.hadoopConfiguration()
    qualified = path.getFileSystem(conf).makeQualified(path)
    return hadoop, qualified, hadoop.FileContext.getFileContext(qualified.toUri(), conf)


def exists(spark: SparkSession, folder: str) -> bool:
    _, path, context = _file_context(spark, folder)
    return context.util().exists(path)


def make_folder(spark: SparkSession, folder: str) -> None:
    _, path, _ = _file_context(spark, folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def move(spark: SparkSession, folder: str, target: str) -> None:
    """Renames a folder; fails if the target is there."""
    hadoop, path, _ = _file_context(spark, target)
    make_folder(spark, path.getParent().toString())
    _, source, context = _file_context(spark, folder)
    context.rename(source, path, spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0))


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder; one that is not there is no error."""
    _, path, _ = _file_context(spark, folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    _, place, _ = _file_context(spark, path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()


def publish(spark: SparkSession, root: str, name: str, entry: dict) -> bool:
    """Publishes an entry below ``root`` under a name; False if that name is published already."""
    hadoop, folder, context = _file_context(spark, f"{root}/{FOLDER}")
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    hidden = hadoop.Path(folder, f".{name}.{uuid.uuid4().hex}")
    out = system.create(hidden, False)
    out.write(bytearray(json.dumps(entry, sort_keys=True).encode()))
    out.close()
    try:
        context.rename(hidden, hadoop.Path(folder, f"{name}.json"), spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0))
    except Py4JJavaError as error:
        system.delete(hidden, False)
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def names(spark: SparkSession, root: str) -> list[str]:
    """Names of all published entries, sorted."""
    hadoop, folder, context = _file_context(spark, f"{root}/{FOLDER}")
    if not context.util().exists(folder):
        return []
    found = [s.getPath().getName() for s in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]
    return sorted(n.removesuffix(".json") for n in found if n.endswith(".json") and not n.startswith("."))


def entry(spark: SparkSession, root: str, name: str) -> dict:
    return json.loads(spark.read.text(f"{root}/{FOLDER}/{name}.json", wholetext=True).first()[0])


def take_number(spark: SparkSession, root: str) -> int:
    """The next number of a counter below ``root``: 0, 1, 2 and so on, each given once."""
    while True:
        number = len(names(spark, root))
        if publish(spark, root, f"{number:012d}", {}):
            return number


def publish_batch(
    spark: SparkSession, path: str, batch_id: int, results: dict[str, DataFrame], offsets: DataFrame | None = None, run: str | None = None,
    before=None,
) -> bool:
    """Publishes all results of a micro-batch of a run, and the offsets it covers, at once and once.

    ``offsets`` has a row per topic partition (``progress.batch_offsets``), which go into the manifest itself. A batch that is
    published already is left as it is; one that failed before that writes new folders. ``before`` is called between
    writing and publishing (tests end the job there).
    """
    run = run or run_of(next(iter(results.values())))
    name = f"{run}.{batch_id:012d}"
    if name in names(spark, path):
        return False
    folders = {}
    for kind, rows in results.items():
        folders[kind] = f"data/{run}/{batch_id}/{uuid.uuid4().hex}/{kind}"
        rows.write.parquet(f"{path}/{folders[kind]}")
    covered = [r.asDict() for r in offsets.collect()] if offsets is not None else []
    if before:
        before()
    return publish(spark, path, name, {"run": run, "batch_id": batch_id, "folders": folders, "offsets": covered})


def _entries(spark: SparkSession, path: str) -> DataFrame:
    layout = (
        "run string, batch_id long, folders map<string, string>, "
        "offsets array<struct<group_id: string, topic: string, partition_id: int, topic_offset: long>>"
    )
    return spark.read.schema(layout).json(f"{path}/{FOLDER}")


def read_published(spark: SparkSession, path: str, kind: str, schema) -> DataFrame:
    """All rows of one kind of result, from published batches only."""
    found = names(spark, path)
    folders = [r[0] for r in _entries(spark, path).select(F.col("folders")[kind]).where(f"folders['{kind}'] is not null").collect()] if found else []
    return spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in folders]) if folders else spark.createDataFrame([], schema)


def published_offsets(spark: SparkSession, path: str, topic: str, group: str) -> dict[int, int]:
    """Next offset per partition after all published batches of a group: where a query without a checkpoint starts (PR4, SRC3)."""
    if not names(spark, path):
        return {}
    rows = _entries(spark, path).select(F.explode("offsets").alias("o")).select("o.*")
    rows = rows.where((F.col("topic") == topic) & (F.col("group_id") == group)).groupBy("partition_id").agg(F.max("topic_offset").alias("n"))
    return {r["partition_id"]: r["n"] for r in rows.collect()}
