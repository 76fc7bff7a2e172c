"""Near copies by SimHash: fingerprints of few differing bits, found by tables of distances to reference fingerprints.

A bit of a text's fingerprint is 1 if over half of the hashes of its word shingles have it. Equal fingerprints are one class before
anything is compared. Two fingerprints that differ in at most ``MOST`` bits differ by at most that in their distance to any
reference, so tables of such distances are made once for each class, and pairs come from them:

1. Each family of references compares only its own share of the bits. ``MOST`` differing bits touch ``MOST`` families at most, so a linked pair
   has the same distances to all references of at least ``FAMILIES - MOST`` families. Classes that agree in so many are candidates.
2. Candidates whose distances to any whole reference are more than ``MOST`` apart are discarded.
3. What is left is verified bit by bit.

A large group of near copies makes many classes that agree in the same families. Where more than ``CROWD`` do, they are not paired
up: each class names the fingerprints that differ from it in one bit at most, and those that name the same one are linked with the
least of them. Two such classes differ in two bits at most, and any two classes that do have one of these in common, so this is
exact for ``MOST`` = 2. Links become components.

A null or empty text, or one without words, has fingerprint zero and is linked like any other. Rows of one id with different
texts are rows of their own; rows without an id take part, and their component has the least id that the others have, or none.
Rows come out once for each input row; other columns of the input are not read.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.batches import mix, slices
from tillstream.llm.components import components, saved

SHINGLE, SEED = 3, 42
MOST = 2  # bits in which linked fingerprints differ
FAMILIES, REFERENCES = 4, 16  # families of references, and references in each; as many compare all bits
CROWD = 16  # classes that agree in the same families and are still compared in pairs
BLOCK = 1 << 20  # bytes of a text whose words are held at once
SMALL = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SPACE = re.compile(rb"[\x20\x09-\x0D]")
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def word_blocks(text: bytes, size: int = BLOCK) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    at = 0
    while at < len(text):
        cut = SPACE.search(text, at + size)
        end = cut.start() if cut else len(text)
        yield text[at:end].translate(SMALL).split()
        at = end


def shingle_hashes(text: bytes, size: int = BLOCK) -> Iterator[np.ndarray]:
    """Hashes of all runs of ``SHINGLE`` words, or of the whole sequence if it is shorter."""
    words, any_yet = [], False
    for block in word_blocks(text, size):
        words += block
        if len(words) >= SHINGLE:
            ends = np.cumsum([len(w) + 1 for w in words])
            starts, joined, of = np.concatenate(([0], ends[:-SHINGLE])).tolist(), b" ".join(words), xxhash.xxh64_intdigest
            yield np.fromiter((of(joined[s:e], SEED) for s, e in zip(starts, (ends[SHINGLE - 1 :] - 1).tolist(), strict=True)), np.uint64)
            words, any_yet = words[1 - SHINGLE :], True
    if words and not any_yet:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)


def fingerprint(text: bytes | None, size: int = BLOCK) -> int:
    """The bits that more than half of the hashes have."""
    ones, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text or b"", size):
        values = hashes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.intp) + np.arange(8) * 256
        ones += (np.bincount(values.ravel(), minlength=2048).reshape(8, 256) @ BITS).ravel()
        n += len(hashes)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and ``f``, the fingerprint as a signed long, of each row."""
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                f = np.array([fingerprint(t) for t in part.column("text").to_pylist()], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(f)], ["doc_id", "f"])

    return rows.mapInArrow(scan, f"doc_id {kind}, f bigint")


def signed(values: np.ndarray) -> list[int]:
    return np.asarray(values, np.uint64).view(np.int64).tolist()


def distances(f: Column, references: list[int], mask: int = -1) -> Column:
    """Hamming distances of a fingerprint to the references, on the bits of the mask."""
    return F.array(*[F.bit_count(f.bitwiseXOR(F.lit(r)).bitwiseAND(F.lit(mask))).cast("tinyint") for r in references])


def with_tables(classes: DataFrame) -> DataFrame:
    """Adds ``whole``, the distances to whole references, and ``keys``, one for each choice of families that a linked pair may agree in."""
    width = 64 // FAMILIES
    masks = signed(np.array([((1 << width) - 1) << (width * i) for i in range(FAMILIES)], np.uint64))
    references = np.array(signed(mix(np.arange(REFERENCES * (FAMILIES + 1)), 12))).reshape(FAMILIES + 1, REFERENCES).tolist()
    f = F.col("f")
    own = {f"_t{i}": F.xxhash64(distances(f, references[i], mask)) for i, mask in enumerate(masks)}
    chosen = itertools.combinations(range(FAMILIES), FAMILIES - MOST)
    keys = F.array(*[F.xxhash64(F.lit(n), *[F.col(f"_t{i}") for i in c]) for n, c in enumerate(chosen)])
    return classes.withColumn("whole", distances(f, references[-1])).withColumns(own).withColumn("keys", keys).drop(*own)


def links(classes: DataFrame) -> DataFrame:
    """Links (a, b) that connect all classes ``f`` of at most ``MOST`` differing bits."""
    tables = saved(with_tables(classes.select("f")), "pivot-tables")
    keyed = tables.select("f", "whole", F.explode("keys").alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    shared = saved(keyed.join(sizes, "key"), "pivot-keys")
    few = shared.where(F.col("size") <= CROWD)
    one = few.select("key", F.col("f").alias("a"), F.col("whole").alias("w_a"))
    two = few.select("key", F.col("f").alias("b"), F.col("whole").alias("w_b"))
    apart = F.array_max(F.zip_with("w_a", "w_b", lambda x, y: F.abs(x - y)))
    pairs = one.join(two, "key").where("a < b").where(apart <= MOST).where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MOST)
    crowd = shared.where(F.col("size") > CROWD).select("f").distinct()
    bits = signed(np.concatenate(([0], np.uint64(1) << np.arange(64, dtype=np.uint64))))
    named = crowd.select("f", F.explode(F.array(*[F.col("f").bitwiseXOR(F.lit(b)) for b in bits])).alias("middle"))
    least = named.groupBy("middle").agg(F.min("f").alias("least"), F.count("*").alias("size")).where("size > 1")
    stars = named.join(least, "middle").where("f <> least").select(F.col("f").alias("a"), F.col("least").alias("b"))
    return pairs.select("a", "b").union(stars).distinct()


def near_copies(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, fingerprint, component_id): 16 hexadecimal digits, and the least id reachable by links."""
    found = saved(fingerprints(docs), "simhash")
    classes = saved(found.groupBy("f").agg(F.min("doc_id").alias("least")), "simhash-classes")
    roots = components(saved(links(classes), "simhash-links"))
    linked = saved(classes.join(roots, F.col("f") == F.col("node")).select("f", "root", "least"), "simhash-roots")
    groups = linked.groupBy("root").agg(F.min("least").alias("group_id"))
    groups = linked.join(groups, "root").select("f", "group_id")
    of_class = classes.join(groups, "f", "left").select("f", F.coalesce("group_id", "least").alias("component_id"))
    text = F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint")
    return found.join(of_class, "f").select("doc_id", text, "component_id")
