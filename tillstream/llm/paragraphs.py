"""Repeated passages: MinHash banding over paragraphs.

Units of comparison are the paragraphs (lines of at least ``LEAST_WORDS`` words) and, so that a passage is found which stands
inside longer paragraphs, the pieces of them. A piece ends where the hash of two words is the least within ``REACH`` words on
both sides; a passage that repeats is therefore cut in the same places, whatever stands around it and however its lines are
wrapped. Pieces run across line breaks; where a line starts inside one, its parts of ``LEAST_PIECE`` words or more are units
too. Equal units are one class, counted before anything is compared. Of the distinct paragraphs, MinHash bands select pairs; their exact Jaccard similarity is
verified, and the links make components.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StructType

from tillstream.llm import near as near_sets
from tillstream.llm.batches import mix, shingles, slices, spaced_words, text_bytes
from tillstream.llm.components import components, saved
from tillstream.llm.jaccard_join import rare_first

SHINGLE = 5
PERCENT = 80
LEAST_WORDS = 8  # of a paragraph that is compared as a whole
LEAST_PIECE = 5  # words of a piece that is compared
LEAST_SPAN = 16  # words of a passage that is reported
GAP = 6  # words between repeated units of one passage at most
REACH = 4
LONG_PIECE = 32  # a longer piece is cut every half of that
ROWS, RECALL = 2, 0.999
BROADCAST_IDS = 1_000_000  # ids sent to all executors at most; more are joined


def bands(rows: int = ROWS, percent: int = PERCENT, recall: float = RECALL) -> int:
    """Bands of so many rows with which a pair at the least similarity collides with that probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - (percent / 100) ** rows))


class Units:
    """Paragraphs and pieces of a slice of texts, as runs of words."""

    def __init__(self, batch: pa.RecordBatch, finder):
        raw, bounds = text_bytes(batch.column("text"))
        starts, ends, self.firsts = finder.find(raw, bounds)
        self.words = finder.hashes(raw, starts, ends)
        n = len(self.words)
        row = np.repeat(np.arange(batch.num_rows), np.diff(self.firsts))
        line = np.cumsum((raw == 10) | (raw == 13))[starts] if n else np.zeros(0, np.int64)
        fresh = np.ones(n, bool)
        fresh[1:] = (row[1:] != row[:-1]) | (line[1:] != line[:-1])
        low = np.flatnonzero(fresh)
        high = np.append(low, n)[1:]
        long = high - low >= LEAST_WORDS
        # Local minima of the hash of each word and the next; beyond a text's ends nothing is less.
        two = mix(self.words) + np.append(self.words[1:], self.words[:0].sum(dtype=np.uint64)) if n else self.words
        two, cut = mix(two, 3), np.ones(n, bool)
        for k in range(1, min(REACH, n - 1) + 1):
            same = row[k:] == row[:-k]
            cut[k:] &= ~same | (two[k:] < two[:-k])
            cut[:-k] &= ~same | (two[:-k] <= two[k:])
        start = np.ones(n, bool)
        start[1:] = row[1:] != row[:-1]
        # Pieces of the whole text, which do not depend on its lines, and those that line starts cut too.
        units = np.concatenate([self._pieces(cut | start, row, joined=True), self._pieces(cut | fresh, row)])
        lines = np.stack([low[long], high[long]], 1)
        units = np.setdiff1d(units[:, 0] * (n + 1) + units[:, 1], lines[:, 0] * (n + 1) + lines[:, 1])
        self.low = np.concatenate([lines[:, 0], units // (n + 1)])
        self.high = np.concatenate([lines[:, 1], units % (n + 1)])
        self.paragraph = np.arange(len(self.low)) < len(lines)
        self.row = row[self.low]
        self.hash = self._hashes(n)

    def _pieces(self, cut: np.ndarray, row: np.ndarray, joined: bool = False) -> np.ndarray:
        """Rows (low, high) of the pieces between cuts; with ``joined`` those too short to be compared go with a neighbour."""
        n, piece = len(cut), np.flatnonzero(cut)
        size = np.diff(np.append(piece, n))
        more = np.where(size > LONG_PIECE, (size - 1) // (LONG_PIECE // 2), 0)  # words that repeat have no local minima
        steps = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
        piece = np.sort(np.concatenate([piece, np.repeat(piece, more) + steps * (LONG_PIECE // 2)]))
        both = np.stack([piece, np.append(piece, n)[1:]], 1)
        short = both[:, 1] - both[:, 0] < LEAST_PIECE
        out = [both[~short]]
        if joined and n:
            at = np.flatnonzero(short)
            back, ahead = np.maximum(at - 1, 0), np.minimum(at + 1, len(both) - 1)
            back = np.where(row[both[back, 0]] == row[both[at, 0]], back, at)
            ahead = np.where((back == at) & (row[both[ahead, 0]] == row[both[at, 0]]), ahead, at)
            wide = np.stack([both[back, 0], both[ahead, 1]], 1)
            out.append(wide[wide[:, 1] - wide[:, 0] >= LEAST_PIECE])
        return np.concatenate(out)

    def _hashes(self, n: int) -> np.ndarray:
        root = 0x9E3779B97F4A7C15
        powers, back = np.full(n + 1, root, np.uint64), np.full(n + 1, pow(root, -1, 2**64), np.uint64)
        powers[0] = back[0] = 1
        powers, back = np.cumprod(powers), np.cumprod(back)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.words * powers[:n], out=sums[1:])
        size = (self.high - self.low).astype(np.uint64)
        return mix((sums[self.high] - sums[self.low]) * back[self.low] + size, 8)

    def paragraph_shingles(self) -> tuple[np.ndarray, np.ndarray]:
        """The shingles of the paragraphs, and for each paragraph the number of those before it."""
        low, high = self.low[self.paragraph], self.high[self.paragraph]
        size = high - low
        ahead = np.concatenate(([0], np.cumsum(size)))
        at = np.repeat(low - ahead[:-1], size) + np.arange(ahead[-1])
        return shingles(self.words[at], ahead, SHINGLE)


def _units(docs: DataFrame, signatures: bool) -> DataFrame:
    """Units as (doc_id, low, high, unit); with ``signatures`` paragraphs only, and the keys of their bands."""
    n_bands = bands()
    schema = StructType([docs.schema["doc_id"]])
    for name in ("low", "high", "unit"):
        schema = schema.add(name, LongType())
    if signatures:
        schema = schema.add("keys", ArrayType(LongType()))

    def run(batches):
        finder = spaced_words()
        for whole in batches:
            for batch in slices(whole):
                units = Units(batch, finder)
                use = np.flatnonzero(units.paragraph) if signatures else np.arange(len(units.low))
                first = units.firsts[units.row[use]]
                columns = [
                    batch.column("doc_id").take(pa.array(units.row[use])), pa.array(units.low[use] - first, pa.int64()),
                    pa.array(units.high[use] - first, pa.int64()), pa.array(units.hash[use].view(np.int64)),
                ]
                if signatures:
                    runs, ahead = units.paragraph_shingles()
                    keys = np.zeros((len(use), n_bands), np.uint64)
                    for k in range(n_bands * ROWS if len(use) else 0):
                        keys[:, k // ROWS] = mix(keys[:, k // ROWS] + np.minimum.reduceat(mix(runs, 50 + k), ahead[:-1]), k)
                    edges = pa.array(np.arange(len(use) + 1) * n_bands, pa.int32())
                    columns.append(pa.ListArray.from_arrays(edges, pa.array(keys.ravel().view(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The sets of shingles of the paragraphs ``wanted`` (doc_id, unit), as (unit, tokens)."""
    ids = wanted.select("doc_id").distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    schema = StructType().add("unit", LongType()).add("tokens", ArrayType(LongType()))

    def run(batches):
        finder = spaced_words()
        for whole in batches:
            for batch in slices(whole):
                units = Units(batch, finder)
                runs, ahead = units.paragraph_shingles()
                sets = [np.unique(runs[a:b]) for a, b in zip(ahead[:-1], ahead[1:], strict=True)]
                flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]), pa.int32()), pa.array(flat.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(units.hash[units.paragraph].view(np.int64)), lists], names=schema.names)

    chosen = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi").mapInArrow(run, schema)
    return chosen.join(wanted.select("unit"), "unit", "left_semi").dropDuplicates(["unit"])


def near_paragraphs(docs: DataFrame) -> DataFrame:
    """Links (a, b) between distinct paragraphs with Jaccard similarity of ``PERCENT`` or more that share a band.

    Within a band each paragraph is compared with the one that stands in most places; then those that are not yet in one
    component are looked at pair by pair (see ``near``). Such a pair shares, beside the key of a band, one of the rare shingles
    without which no similarity of ``PERCENT`` is possible; so paragraphs with a frequent passage in common are not paired up.
    """
    distinct = _units(docs, signatures=True).groupBy("unit").agg(F.min(F.struct("doc_id", "keys")).alias("p"), F.count("*").alias("places"))
    keyed = distinct.select("unit", "p.doc_id", (-F.col("places")).alias("rank"), F.posexplode("p.keys").alias("band", "key"))
    keyed = keyed.repartition("band", "key")  # both sides of the join below keep to it: the bands are shuffled once
    many = keyed.groupBy("band", "key").agg(F.min(F.struct("rank", "unit"))["unit"].alias("p"), F.count("*").alias("n")).where("n > 1")
    keyed = saved(keyed.join(many.select("band", "key", "p"), ["band", "key"]).withColumnRenamed("unit", "node"), "bands")
    wanted = keyed.select("doc_id", F.col("node").alias("unit")).distinct()
    sets = saved(_shingle_sets(docs, wanted).withColumnRenamed("unit", "node"), "paragraphs")
    near, roots, differences = near_sets.with_centres(keyed.select("node", "p"), sets, PERCENT)
    rare = rare_first(sets.withColumn("n", F.size("tokens").cast("long")), PERCENT)
    facts = near_sets.with_facts(rare, roots, differences)
    spread = keyed.select("band", "key", "node", "rank").join(facts, "node").select("*", F.posexplode("prefix").alias("after", "token"))
    spread = spread.withColumn("at", F.col("own") + F.col("after")).drop("own", "prefix", "after")
    rest = near_sets.open_pairs(spread, ["band", "key", "token"], PERCENT)
    near = near.union(near_sets.links_by_differences(differences, roots, PERCENT))
    return near.union(near_sets.linked(near_sets.compared(rest, sets), PERCENT))


def repeats(docs: DataFrame, least_span: int = LEAST_SPAN) -> DataFrame:
    """Passages that stand in several documents: (doc_id, first_word, end_word, keeper, removed).

    Words are runs of characters other than white space, counted from 0; the end is exclusive. ``keeper`` is the least id of
    the documents that hold the passage's first repeated unit; in that document the passage stays (``removed`` is false), in
    all others it goes. Repeated units of a document with at most ``GAP`` words between them make one passage, if their
    keepers are equally the document itself or another; passages of fewer than ``least_span`` words are left alone, and so are
    repetitions within one document. Null and empty texts have none. Rows of one id count as one document.
    """
    units = _units(docs, signatures=False)
    links = saved(near_paragraphs(docs), "paragraph-links")  # the rounds below read them many times: not with the joins that make them
    roots = components(links).withColumnRenamed("node", "unit")
    exact = units.groupBy("unit").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    # Classes: units of equal words, joined by the components of near ones.
    classes = exact.join(roots, "unit", "left").select("unit", F.coalesce("root", "unit").alias("root"), "root", "least", "most")
    classes = classes.toDF("unit", "class", "root", "least", "most").where("root is not null or least <> most")
    spread = classes.groupBy("class").agg(F.min("least").alias("keeper"), F.max("most").alias("most")).where("keeper <> most")
    repeated = saved(classes.select("unit", "class").join(spread.select("class", "keeper"), "class").select("unit", "keeper"), "classes")
    found = units.join(repeated, "unit").select("doc_id", "low", "high", "keeper")
    # A document's spans are no more than its words: one row for each document, with its spans in order.
    spans = found.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("low", "high", "keeper"))).alias("spans"))
    schema = StructType([docs.schema["doc_id"]]).add("first_word", LongType()).add("end_word", LongType())
    schema = schema.add("keeper", docs.schema["doc_id"].dataType).add("removed", BooleanType())

    def run(batches):
        for batch in batches:
            out = []
            for doc_id, rows in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "spans")), strict=True):
                merged: list[list] = []
                for row in rows:
                    removed = row["keeper"] != doc_id
                    # A span of the other kind may lie between two of one kind; each kind has its own last passage.
                    last = next((m for m in reversed(merged) if m[3] == removed), None)
                    if last and row["low"] <= last[1] + GAP:
                        last[1] = max(last[1], row["high"])
                    else:
                        merged.append([row["low"], row["high"], row["keeper"], removed])
                out += [(doc_id, *m) for m in merged if m[1] - m[0] >= least_span]
            if out:
                types = [batch.schema.field("doc_id").type, pa.int64(), pa.int64(), batch.schema.field("doc_id").type, pa.bool_()]
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return spans.mapInArrow(run, schema)
