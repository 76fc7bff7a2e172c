"""Tables in the shared folder, and connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.streaming.runtime import shared_folder


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the folder that all executors share and read again: lost executors cost no recomputation."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """For each node of the links (a, b) the least node of its component: columns node, root.

    Each round joins every node's greater neighbours to its least one, then its lesser ones; the links of a round are
    written to the shared folder. It ends when a round changes nothing, after a number of rounds that grows with the
    logarithm of the size. A node with many links costs one partial aggregation and a join that adaptive execution splits.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    before = None
    for _ in range(most_rounds):
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        lesser = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = saved(lesser.union(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components are not found after {most_rounds} rounds")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select("b", "b").distinct().toDF("node", "root")
    )
