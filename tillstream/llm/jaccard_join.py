"""Similarity join of documents on word n-grams, filtered by prefixes under several global orders.

Two sets whose Jaccard similarity is at least ``t`` share a token among the first ``n - ceil(t * n) + 1`` tokens of either,
under any order of all tokens. Here a pair must do so under several orders:

1. by hash, with half as many tokens again, so that linked sets share more than one of them;
2. by frequency among those, the rarest first, which leaves out the tokens that many documents share;
3. by frequency over the whole sets of the documents that are left: one with too many tokens of its own has no links, and a
   pair's first common token must stand early enough in both sets;
4. by two more hashes, on the pairs that are left.

What passes is verified exactly. Equal sets are one class before all this. Classes that share their least token under one of
a few hashes are compared with one member of that group first, the one with the fewest tokens of its own, so that a large group
of near copies is not paired up (see ``near``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from tillstream.llm.batches import mix, shingles, slices, spaced_words, text_bytes
from tillstream.llm.components import components, saved
from tillstream.llm.near import compared, linked, links_by_differences, open_pairs, with_centres, with_facts

SHINGLE = 4
PERCENT = 85  # of the union that linked sets have in common
FIRST, FURTHER = 101, (102, 103)  # seeds of the orders by hash
PIVOTS = (201, 202, 203)  # seeds of the groups that are compared with one member first
BROADCAST_IDS = 1_000_000  # ids sent to all executors at most: 8 MB; more are joined


def prefix(n, percent: int = PERCENT):
    """Tokens of ``n`` among which a linked set has one."""
    return n - (percent * n + 99) // 100 + 1


def extended(n, percent: int = PERCENT):
    p = prefix(n, percent)
    return np.minimum(n, p + p // 2)


def kept(n: int, percent: int = PERCENT) -> int:
    """How many of the rarest of the ``extended`` tokens must be kept so that linked sets share one of them.

    Linked sets share at least ``e - p + 1`` of the extended tokens, where ``e`` and ``p`` are those of the smaller set,
    which has at least ``percent`` of ``n`` tokens.
    """
    least = (percent * n + 99) // 100
    shared = int(extended(least, percent)) - int(prefix(least, percent)) + 1
    return int(extended(n, percent)) - shared + 1


def _rows(batches, size: int):
    """Arrow batches with the distinct shingles of each of their rows, in ascending order."""
    finder = spaced_words()
    for whole in batches:
        for batch in slices(whole):
            raw, bounds = text_bytes(batch.column("text"))
            starts, ends, firsts = finder.find(raw, bounds)
            runs, ahead = shingles(finder.hashes(raw, starts, ends), firsts, size)
            yield batch, [np.unique(runs[a:b]) for a, b in zip(ahead[:-1], ahead[1:], strict=True)]


def _lists(rows: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()), pa.array(flat.view(np.int64)))


def _least(tokens: np.ndarray, n: int, seed: int) -> np.ndarray:
    """The first ``n`` tokens in the order by that hash."""
    order = mix(tokens, seed)
    return tokens[np.argpartition(order, n - 1)[:n]] if n < len(tokens) else tokens


def token_sets(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """For each document its number of shingles, a 128-bit hash of their set, and the extended prefix of the first order."""
    schema = StructType([docs.schema["doc_id"]])
    for name in ("n", "f1", "f2"):
        schema = schema.add(name, LongType())
    schema = schema.add("first", ArrayType(LongType())).add("keep", LongType())

    def run(batches):
        for batch, sets in _rows(batches, size):
            n = np.asarray([len(s) for s in sets], np.int64)
            sums = [np.asarray([mix(s, k).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64) for k in (1, 2)]
            first = [_least(s, int(extended(len(s), percent)), FIRST) if len(s) else s for s in sets]
            keep = np.asarray([kept(int(k), percent) if k else 0 for k in n], np.int64)
            columns = [batch.column("doc_id"), pa.array(n), *map(pa.array, sums), _lists(first), pa.array(keep)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def whole_sets(docs: DataFrame, ids: DataFrame, size: int, percent: int) -> DataFrame:
    """The whole sets of the documents with these ids, their prefixes under the further orders, and their group keys."""
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    schema = StructType([docs.schema["doc_id"]]).add("n", LongType())
    for name in ("tokens", *(f"order_{k}" for k in FURTHER)):
        schema = schema.add(name, ArrayType(LongType()))
    for k in PIVOTS:
        schema = schema.add(f"group_{k}", LongType())

    def run(batches):
        for batch, sets in _rows(batches, size):
            sizes = [len(s) for s in sets]
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), _lists(sets)]
            for seed in FURTHER:
                columns.append(_lists([_least(s, prefix(len(s), percent), seed) for s in sets]))
            for seed in PIVOTS:
                columns.append(pa.array(np.asarray([mix(s, seed).min() for s in sets], np.uint64).view(np.int64)))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    chosen = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    return chosen.mapInArrow(run, schema).dropDuplicates(["doc_id"])


def rare_first(sets: DataFrame, percent: int) -> DataFrame:
    """Of the sets (node, n, tokens) those that can have a link, with their prefix under the order by frequency.

    Columns node, n, own (tokens that no other set has; they come first in the order) and prefix (the tokens after these).
    The order is one for all sets, so linked ones share a token of their prefixes; a prefix of own tokens only has none to share.
    """
    spread = sets.select("node", "n", F.explode("tokens").alias("token"))
    often = spread.groupBy("token").agg(F.count("*").alias("often")).where("often > 1")
    found = spread.join(often, "token").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("often", "token"))).alias("found"))
    found = found.withColumn("own", F.col("n") - F.size("found"))
    room = F.expr(f"int(n - ceil({percent} * n / 100BD) + 1 - own)")
    return found.where(room > 0).select("node", "n", "own", F.slice("found.token", F.lit(1), room).alias("prefix"))


def classes(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Columns doc_id, n_shingles and component_id: the least doc_id that can be reached by links, the document's own included.

    A document's set is that of its distinct runs of ``size`` words, or its whole sequence if it has fewer. Without a word
    the set is empty and linked with nothing; a null text counts as empty. Repeated rows each have a row. Rows of one id count
    as one document. A row without an id has the component of the rows with an equal set, if there are any.
    """
    rows = saved(token_sets(docs, size, percent), "sets")
    full = rows.where("n > 0")
    same = full.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("node"))
    node = same.where("node is not null").select(F.col("node").alias("doc_id"))
    firsts = full.select("doc_id", "first", "keep").join(node, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    # Second order: by frequency. Tokens of one class only come first in it, and are of no use.
    spread = firsts.select("doc_id", F.explode("first").alias("token"))
    often = spread.groupBy("token").agg(F.count("*").alias("often")).where("often > 1")
    common = spread.join(often, "token").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("often", "token"))).alias("found"))
    total = full.select("doc_id", F.size("first").alias("total"), "keep").dropDuplicates(["doc_id"])
    room = F.col("keep") - (F.col("total") - F.size("found"))
    left = common.join(total, "doc_id").where(room > 0).select("doc_id")
    sets = whole_sets(docs, saved(left, "left"), size, percent)
    sets = saved(sets.withColumnRenamed("doc_id", "node"), "tokens")
    shared = saved(rare_first(sets, percent), "prefixes")

    keys = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"group_{k}").alias("g")) for k in PIVOTS])).alias("x")
    keys = sets.select("node", keys).select("node", "x.*").join(shared.select("node", "own"), "node")
    pivot = keys.groupBy("k", "g").agg(F.min(F.struct("own", "node"))["node"].alias("p"), F.count("*").alias("many")).where("many > 1")
    groups = keys.join(pivot.select("k", "g", "p"), ["k", "g"]).select("node", "p")
    near, roots, differences = with_centres(groups, sets, percent)
    facts = with_facts(shared.withColumnRenamed("own", "rank"), roots, differences)
    spread = facts.select(F.posexplode("prefix").alias("after", "token"), "node", "n", "rank", "root", "ps")
    spread = spread.withColumn("at", F.col("rank") + F.col("after")).drop("after")
    pairs = open_pairs(spread, ["token"], percent)
    for k in FURTHER:
        one, two = (sets.select(F.col("node").alias(x), F.col(f"order_{k}").alias(f"o_{x}")) for x in "ab")
        pairs = pairs.join(two, "b").join(one, "a").where(F.arrays_overlap("o_a", "o_b")).select("a", "b")
    links = near.union(links_by_differences(differences, roots, percent)).union(linked(compared(pairs, sets), percent))
    final = components(saved(links, "linked"))

    of_class = same.join(final, same["node"] == final["node"], "left")
    of_class = of_class.select("n", "f1", "f2", F.coalesce("root", same["node"]).alias("component"))
    found = rows.select("doc_id", "n", "f1", "f2").join(of_class, ["n", "f1", "f2"], "left")
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
