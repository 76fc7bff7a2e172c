"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm import (
    bpe, decontaminate, jaccard_join, language, licenses, mixing, order_minhash, paragraphs, pii, prefix_trie, quality, simhash, spelling,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_licenses(spark, sf_dir):
    return licenses.license_scan(documents(spark, sf_dir))


@query
def op8_token_counts(spark, sf_dir):
    import public_tokenizers

    return bpe.token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op2_language(spark, sf_dir):
    docs = documents(spark, sf_dir)
    found = language.predict(docs, language.learn(docs.select("doc_id", "text", "lang")))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op5_quality(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = quality.fit(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"))
    found = quality.score(docs, model)
    good = (F.col("score") >= quality.ACCEPT).cast("int")
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "score", good.alias("predicted"))


@query
def op7_personal_data(spark, sf_dir):
    return pii.find(documents(spark, sf_dir))


@query
def op10_fingerprints(spark, sf_dir):
    return order_minhash.fingerprints(documents(spark, sf_dir))


@query
def op3_decontamination(spark, sf_dir):
    return decontaminate.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op4_jaccard_join(spark, sf_dir):
    return jaccard_join.classes(documents(spark, sf_dir))


@query
def op9_mixing(spark, sf_dir):
    return mixing.mixture(documents(spark, sf_dir))


@query
def op6_paragraphs(spark, sf_dir):
    return paragraphs.repeats(documents(spark, sf_dir))


@query
def op11_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query
def op12_simhash(spark, sf_dir):
    return simhash.near_copies(documents(spark, sf_dir))


@query
def op13_spelling(spark, sf_dir):
    return spelling.variants(documents(spark, sf_dir))
