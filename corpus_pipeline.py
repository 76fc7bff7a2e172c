"""From raw documents to a training mixture: every stage works on what the stage before it kept.

``STAGES`` names the functions in their order; each takes the session, the documents (doc_id, text, lang, source, n_chars) and
the folder of the tables. All but the last return documents. ``run`` applies them to the table ``documents``; between two
stages the documents are written to the folder that all executors share.

A null or empty text is a document without words: it has a score like any other, is in no group, holds no passage and no
personal data, and has no tokens to mix. Rows of one id count as one document and stay or go together; rows without an id go
only for their own quality. Further columns of the input are kept as they are up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm import decontaminate, jaccard_join, mixing, pii, quality
from tillstream.llm.components import saved

BROADCAST_IDS = 1_000_000  # ids sent to all executors at most; more are joined


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents whose id is not among ``gone``."""
    gone = saved(gone.where("doc_id is not null").distinct(), "gone")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = quality.fit(docs.select("doc_id", "text"), labels)
    scored = quality.score(docs.select(F.struct(*docs.columns).alias("row"), "text"), model, keep=("row",))
    return scored.where(F.col("score") >= quality.ACCEPT).select("row.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by similar word n-grams the one with the least id."""
    found = jaccard_join.classes(docs)
    return without(docs, found.where("component_id <> doc_id").select("doc_id"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return without(docs, decontaminate.leaks(docs, items).select("doc_id"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind in brackets; ``n_chars`` is that of the new text."""
    rest = [c for c in docs.columns if c != "text"]
    found = pii.find(docs.select(F.struct(*rest).alias("row"), "text"), keep=("row",), mask=True)
    changed = found.select("row.*", F.col("masked").alias("text"))
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mixture takes, one row for each time."""
    return mixing.mixture(docs)


STAGES = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("PII", without_personal_data),
    ("mixing sources to target weights", mixed),
]
ORACLE_SQL = None  # a learned classifier and a disguise remover have no SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
