"""Document fingerprints by Order MinHash: likeness of texts in the sense of edit distance."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from tillstream.llm.batches import mix

K = 8  # characters of a k-mer
TUPLE = 2  # k-mers in a tuple
HASHES = 32  # tuples of a fingerprint
BLOCK = 1 << 13  # k-mers whose hashes are compared at once


def fingerprint(text: str, k: int = K, tuple_size: int = TUPLE, hashes: int = HASHES) -> np.ndarray:
    """One 32-bit value for each hash function.

    Each k-mer is taken with the number of its occurrence. A hash function picks the ``tuple_size`` least of them, keeps
    them in text order, and the value is the hash of that tuple. A text shorter than ``k`` is one k-mer; a text with fewer
    than ``tuple_size`` k-mers uses all of them; the empty text has values of its own.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    seeds = mix(np.arange(hashes), 3)
    if not len(codes):
        return mix(seeds, 11).astype(np.uint32)
    mers = kmer_hashes(codes, min(k, len(codes)))
    n = len(mers)
    # Occurrences: sort by k-mer, positions in the low bits; a run of equal k-mers is numbered in text order.
    low = np.uint64(max(1, int(n - 1).bit_length()))
    ones = (np.uint64(1) << low) - np.uint64(1)
    keys = np.sort((mers & ~ones) | np.arange(n, dtype=np.uint64))
    run = keys >> low
    again = np.flatnonzero(run[1:] == run[:-1]) + 1
    if len(again):
        # The number of an entry is its distance from the start of its run.
        index = np.arange(n)
        index[again] = 0
        number = (again - np.maximum.accumulate(index)[again]).astype(np.uint64)
        place = (keys[again] & ones).astype(np.int64)
        mers[place] = mix(mers[place] + number, 21)
    small = (mers >> np.uint64(16)).astype(np.uint32)
    factors = (seeds.astype(np.uint32) | np.uint32(1))[:, None]
    take, every = min(tuple_size, n), np.arange(hashes)
    values, places = [], []
    for begin in range(0, n, BLOCK):
        work = small[None, begin : begin + BLOCK] * factors
        for _ in range(min(take, work.shape[1])):
            at = work.argmin(1)
            values.append(work[every, at])
            places.append(at + begin)
            work[every, at] = np.iinfo(np.uint32).max
    places = np.stack(places, 1)
    least = np.stack(values, 1).argsort(axis=1, kind="stable")[:, :take]
    chosen = mers[np.sort(np.take_along_axis(places, least, 1), axis=1)]
    value = seeds.copy()
    for i in range(take):
        value = mix(value + chosen[:, i], i + 31)
    return (value >> np.uint64(32)).astype(np.uint32)


def kmer_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` characters: those of runs of 1, 2, 4 and so on characters, joined by the bits of ``k``."""
    root, size, power, out, done = 0x100000001B3, 1, codes, None, 0
    n = len(codes) - k + 1
    while size <= k:
        if k & size:
            out = power[:n].copy() if out is None else out * np.uint64(pow(root, size, 2**64)) + power[done : done + n]
            done += size
        if 2 * size <= k:
            power = power[:-size] * np.uint64(pow(root, size, 2**64)) + power[size:]
        size *= 2
    return mix(out, k)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal values."""
    return float(np.mean(a == b))


def shown(values: np.ndarray) -> str:
    return values.astype(">u4").tobytes().hex()


def edited(text: str, other: str) -> str:
    """The text with its last half replaced by as many of the other's first characters, or by all of them."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def with_next(docs: DataFrame, parts: int) -> DataFrame:
    """Rows (part, copy, doc_id, text) such that, in a part's order, each row's next document is the row after it.

    Documents are cut into ``parts`` ranges of descending ids, of about equal numbers of rows; a range also gets a copy of
    the first row of the range after it, and the last range one of the very first. Only the cuts and each range's first id
    come to the driver.
    """
    ids = docs.where(F.col("doc_id").isNotNull())
    shares = [i / parts for i in range(1, parts)]
    cuts = ids.agg(F.percentile_approx("doc_id", shares, 10_000).alias("c")).first()["c"] if shares else []
    cuts = np.unique(np.asarray(cuts or [], np.int64))

    @F.pandas_udf("int")
    def part_of(doc_id):
        # Descending: the greatest ids are in part 0, null ids in the last.
        known = doc_id.fillna(0).to_numpy(np.int64) if doc_id.isna().any() else doc_id.to_numpy(np.int64)
        import pandas as pd

        return pd.Series(np.where(doc_id.isna(), len(cuts), len(cuts) - np.searchsorted(cuts, known, "left")).astype(np.int32))

    placed = docs.select("doc_id", "text").withColumn("part", part_of("doc_id"))
    tops = placed.select("part", "doc_id").groupBy("part").agg(F.max("doc_id").alias("top")).orderBy("part").collect()
    if not tops:
        return placed.select("part", F.lit(0).alias("copy"), "doc_id", "text")
    # The first row of a range, among equal ids the one with the least text, goes to the range before it as well.
    target = {row["part"]: before["part"] for row, before in zip(tops, [tops[-1], *tops[:-1]], strict=True)}
    heads = spark_frame(docs, [(r["part"], r["top"], target[r["part"]]) for r in tops])
    same = placed["part"].eqNullSafe(heads["h_part"]) & placed["doc_id"].eqNullSafe(heads["top"])
    first = (
        placed.join(F.broadcast(heads), same)  # one row for each range
        .groupBy("target").agg(F.min_by(F.struct("doc_id", "text"), F.struct(F.coalesce("text", F.lit("")), F.col("text").isNotNull())).alias("d"))
        .select(F.col("target").alias("part"), F.lit(1).alias("copy"), "d.doc_id", "d.text")
    )
    return placed.select("part", F.lit(0).alias("copy"), "doc_id", "text").unionByName(first)


def spark_frame(docs: DataFrame, rows) -> DataFrame:
    return docs.sparkSession.createDataFrame(rows, "h_part int, top bigint, target int")


def fingerprints(docs: DataFrame, hashes: int = HASHES, parts: int | None = None) -> DataFrame:
    """Fingerprints of each document of ``docs`` (doc_id, text), of its edited text, and their likeness.

    The next document is the one with the next lower id; the last one's is the first. Rows with equal ids are ordered by
    text, and rows without an id come last. A null text counts as empty. Two empty texts are alike (1). A single row is
    its own next document. Of repeated rows each has a row, and its next is the next in that order.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = (
        StructType().add("doc_id", docs.schema["doc_id"].dataType).add("n_chars", LongType()).add("edited_sha256", StringType())
        .add("fingerprint", StringType()).add("edited_fingerprint", StringType()).add("near_edited", DoubleType())
        .add("near_next", DoubleType())
    )
    arrow = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def compare(doc_id, text, values, after, after_values):
        new = edited(text, after)
        new_values = values if new == text else fingerprint(new, hashes=hashes)
        digest = hashlib.sha256(new.encode("utf8", "surrogatepass")).hexdigest()
        return (
            doc_id, len(text), digest, shown(values), shown(new_values), likeness(values, new_values), likeness(values, after_values),
        )

    def run(batches):
        before = None
        for batch in batches:
            done = []
            columns = [batch.column(c).to_pylist() for c in ("part", "copy", "doc_id", "text")]
            for part, copy, doc_id, text in zip(*columns, strict=True):
                text = text or ""
                values = before[3] if before and before[2] == text else fingerprint(text, hashes=hashes)
                if before and before[0] == part:
                    done.append(compare(*before[1:4], text, values))
                before = None if copy else (part, doc_id, text, values)
            if done:
                rows = zip(*done, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, arrow, strict=True)], names=schema.names)

    placed = with_next(docs, parts)
    order = ["part", "copy", F.col("doc_id").desc_nulls_last(), "text"]
    return placed.repartition(parts, "part").sortWithinPartitions(*order).mapInArrow(run, schema)
