"""Benchmark decontamination: item-sized windows embedded so that edit distance becomes Hamming distance.

The symbols are words (digits, letters a-z in either case, characters of other scripts), so case and punctuation do not
count. In scripts that are written without spaces each character is a symbol. A window matches an item of ``n`` words within ``floor(n * (1 - similarity))`` word edits. A random walk reads each
sequence: at every step it emits the symbol it stands on, and a random bit of step and symbol decides whether it moves on.
Two sequences at a small edit distance fall into step again, so their outputs differ in few places, and equal samples of the
outputs are likely. Samples are drawn again and again until the target recall is reached; equal ones are verified exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructType

from tillstream.llm.batches import Words, byte_class, mix, slices, text_bytes

SIMILARITY = 0.8
RECALL = 0.99
SAMPLED = 2  # positions in a sample
MOST_REPEATS = 64
LEAST_WORDS = 2  # an item of one symbol is no passage: it matches nothing
# Scripts without spaces between words: South-East Asian ones and Tibetan, kana, bopomofo, Han, Yi.
UNSPACED = (
    (0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F), (0x3005, 0x3007),
    (0x3040, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA000, 0xA4CF), (0xA980, 0xA9FF),
    (0xAA60, 0xAA7F), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFF),
)
BLOCK_ITEMS, BLOCK_CHARS = 20_000, 20_000_000  # items that are sent to the executors at once; more are taken in blocks
SEED = 17


def benchmark_words() -> Words:
    return Words(byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)))


def symbols(finder: Words, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each symbol, and for each row the number of symbols before it: words, cut around each character of ``UNSPACED``."""
    starts, ends, firsts = finder.find(raw, bounds)
    at = np.flatnonzero(raw >= 0xE0)  # first bytes of characters of three or four bytes; all of ``UNSPACED`` are such
    if not len(at):
        return starts, ends, firsts
    b = [raw[np.minimum(at + k, len(raw) - 1)].astype(np.int64) & 0x3F for k in range(4)]
    four = raw[at] >= 0xF0
    code = np.where(four, (b[0] & 7) << 18 | b[1] << 12 | b[2] << 6 | b[3], (b[0] & 15) << 12 | b[1] << 6 | b[2])
    lows, highs = np.asarray(UNSPACED).T
    part = np.searchsorted(lows, code, "right") - 1
    single = (part >= 0) & (code <= highs[part])
    at, size = at[single], np.where(four, 4, 3)[single]
    cuts = np.union1d(at, at + size)
    cuts = cuts[~np.isin(cuts, starts) & ~np.isin(cuts, ends)]
    starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
    return starts, ends, np.searchsorted(starts, bounds)


def allowed_edits(n: int, similarity: float) -> int:
    return int(n * (1 - similarity) + 1e-9)


class Walks:
    """Random walks of ``repeats`` kinds, and for each kind the steps at which their outputs are sampled."""

    def __init__(self, repeats: int):
        self.repeats = repeats
        self.kinds = np.arange(repeats)

    def steps(self, n: int) -> np.ndarray:
        """Sampled steps of walks over ``n`` words, one row for each kind. A walk takes two steps a word on average."""
        return (mix(np.arange(self.repeats * SAMPLED) + 1000 * n, SEED) % np.uint64(2 * n)).astype(np.int64).reshape(-1, SAMPLED)

    def samples(self, windows: np.ndarray, n: int) -> np.ndarray:
        """The sampled outputs of each row of ``windows``, in the shape (rows, kinds, samples). Past the end the symbol is 0."""
        rows, width = windows.shape
        padded = np.concatenate([windows, np.zeros((rows, 1), np.uint64)], axis=1)
        steps = self.steps(n)
        out = np.zeros((rows, self.repeats, SAMPLED), np.uint64)
        at = np.zeros((rows, self.repeats), np.int64)
        line = np.arange(rows)[:, None]
        for step in range(int(steps.max()) + 1):
            symbol = padded[line, np.minimum(at, width)]
            for s in range(SAMPLED):
                here = steps[:, s] == step
                out[:, here, s] = symbol[:, here]
            at += (mix(symbol + mix(self.kinds + 7919 * step, SEED)[None, :]) & np.uint64(1)).astype(np.int64)
        return out


def edited_at_random(words: np.ndarray, edits: int, draw: np.random.Generator) -> np.ndarray:
    out = list(words)
    for _ in range(edits):
        kind, at = draw.integers(3), int(draw.integers(max(len(out), 1)))
        if kind == 0 and out:
            out[at] = draw.integers(1, 2**63)
        elif kind == 1:
            out.insert(at, draw.integers(1, 2**63))
        elif len(out) > 1:
            del out[at]
    return np.asarray(out, np.uint64)


def repeats_needed(items: list[np.ndarray], similarity: float, recall: float) -> int:
    """The number of repeats with which the samples find that share of windows with all the edits that are allowed.

    Measured on up to 100 items and random edits; the walks over other items follow the same law.
    """
    items = [item for item in items if allowed_edits(len(item), similarity)]  # equal windows have equal samples
    if not items:
        return 1
    draw = np.random.default_rng(SEED)
    walks, hits = Walks(MOST_REPEATS), []
    for item in items[:: max(1, len(items) // 100)][:100]:
        n = len(item)
        window = edited_at_random(item, allowed_edits(n, similarity), draw)[None, :]
        hits.append((walks.samples(item[None, :], n) == walks.samples(window, n)).all(2)[0])
    found = np.logical_or.accumulate(np.asarray(hits, bool).reshape(-1, MOST_REPEATS), axis=1).mean(0)
    enough = np.flatnonzero(found >= recall)
    return int(enough[0]) + 1 if len(enough) else MOST_REPEATS


def best_fit(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """The least edit distance between the item and any run of the words, and that run's start and end."""
    m = len(words)
    index = np.arange(m + 1)
    cost, start = np.zeros(m + 1, np.int64), index.copy()
    for i, word in enumerate(item):
        keep = cost[:-1] + (words != word)
        drop = cost[1:] + 1
        best = np.concatenate(([i + 1], np.minimum(keep, drop)))
        came = np.concatenate(([0], np.where(keep <= drop, start[:-1], start[1:])))
        # Further words of the text cost one each: the least of best[k] + (j - k) over k up to j, the last such k.
        base = best - index
        low = np.minimum.accumulate(base)
        source = np.maximum.accumulate(np.where(base == low, index, 0))
        cost, start = low + index, came[source]
    end = int(cost.argmin())
    return int(cost[end]), int(start[end]), end


class Items:
    """A block of items, ready for the executors."""

    def __init__(self, ids: list, texts: list[str], similarity: float, recall: float):
        finder = benchmark_words()
        raw, bounds = text_bytes(pa.array(texts, pa.string()))
        starts, ends, firsts = symbols(finder, raw, bounds)
        hashes = finder.hashes(raw, starts, ends)
        every = [hashes[a:b] for a, b in zip(firsts[:-1], firsts[1:], strict=True)]
        kept = [i for i, w in enumerate(every) if len(w) >= LEAST_WORDS]
        self.ids, self.words = [ids[i] for i in kept], [every[i] for i in kept]
        self.edits = [allowed_edits(len(w), similarity) for w in self.words]
        self.walks = Walks(repeats_needed(self.words, similarity, recall))
        self.samples = [self.walks.samples(w[None, :], len(w))[0] for w in self.words]
        # An item cut into one piece more than there may be edits keeps a piece whole in every match. Windows without such a
        # piece in its place cannot match, and are not embedded.
        pieces: dict[int, list] = {}
        for i, (words, edits) in enumerate(zip(self.words, self.edits, strict=True)):
            cuts = [k * len(words) // (edits + 1) for k in range(edits + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                pieces.setdefault(b - a, []).append((run_hash(words[a:b]), i, a))
        self.pieces = {}
        for size, rows in sorted(pieces.items()):
            rows.sort()
            table = np.asarray([r[0] for r in rows], np.uint64)
            maybe = np.zeros(1 << 20, bool)
            maybe[table >> np.uint64(44)] = True
            self.pieces[size] = (table, np.asarray([r[1:] for r in rows], np.int64), maybe)


def run_hash(words: np.ndarray) -> int:
    out = np.zeros(1, np.uint64)
    for word in words:
        out = mix(out) + word
    return int(mix(out, 5)[0])


def places(words: np.ndarray, firsts: np.ndarray, items: Items) -> np.ndarray:
    """Distinct (row, item, start): windows of item size that hold a piece of the item in its place; starts may be negative."""
    found = []
    run = np.zeros(len(words), np.uint64)
    for size in range(1, max(items.pieces, default=0) + 1):
        n = len(words) - size + 1
        if n <= 0:
            break
        run = mix(run[:n]) + words[size - 1 :]
        if size not in items.pieces:
            continue
        table, whose, maybe = items.pieces[size]
        hashes = mix(run, 5)
        at = np.flatnonzero(maybe[hashes >> np.uint64(44)])
        low, high = np.searchsorted(table, hashes[at], "left"), np.searchsorted(table, hashes[at], "right")
        at, low, count = at[high > low], low[high > low], (high - low)[high > low]
        if not len(at):
            continue
        rows = np.searchsorted(firsts, at, "right") - 1
        inside = at + size <= firsts[rows + 1]
        at, low, count, rows = at[inside], low[inside], count[inside], rows[inside]
        entry = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        item, offset = whose[entry, 0], whose[entry, 1]
        found.append(np.stack([np.repeat(rows, count), item, np.repeat(at - firsts[rows], count) - offset], 1))
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)


def matches(words: np.ndarray, firsts: np.ndarray, items: Items):
    """For each row and item the best match (row, item, distance, start, end), if there is one."""
    best: dict[tuple[int, int], tuple] = {}
    for row, item, start in places(words, firsts, items).tolist():
        have = best.get((row, item))
        if have and have[0] == 0:
            continue
        text, wanted, edits = words[firsts[row] : firsts[row + 1]], items.words[item], items.edits[item]
        n, step = len(wanted), max(1, edits // 3)
        shifts = np.unique(np.concatenate([np.arange(0, edits + 1, step), -np.arange(0, edits + 1, step)])) + start
        at = shifts[:, None] + np.arange(n)[None, :]
        inside = (at >= 0) & (at < len(text))
        windows = np.where(inside, text[np.clip(at, 0, len(text) - 1)], np.uint64(0))
        if not (items.walks.samples(windows, n) == items.samples[item][None]).all(2).any():
            continue
        a, b = max(0, start - edits), min(len(text), start + n + edits)
        distance, low, high = best_fit(wanted, text[a:b])
        if distance <= edits and (have is None or (distance, a + low) < have[:2]):
            best[row, item] = (distance, a + low, a + high)
    return [(row, item, *values) for (row, item), values in sorted(best.items())]


def item_blocks(benchmark: DataFrame):
    """The benchmark's items in blocks of bounded size; equal ids with other texts are items of their own."""
    size = benchmark.agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).first()
    blocks = max(1, -(-size["n"] // BLOCK_ITEMS), -(-(size["chars"] or 0) // BLOCK_CHARS))
    for block in range(blocks):
        part = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield part.select("item_id", "text").distinct().orderBy("item_id", "text").collect()


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """Pairs (doc_id, item_id) whose document holds a passage within the allowed word edits of the item.

    ``distance`` is the least found, ``similarity`` is 1 - distance / words of the item, and the passage reaches from word
    ``first_word`` to before ``end_word``, in symbols. Items too short for an edit match equal passages only. Null and empty texts
    and items of fewer than ``LEAST_WORDS`` words match nothing.
    A repeated document row gives its pairs again. No row is shuffled: the items go to the texts, block by block.
    """
    schema = StructType([docs.schema["doc_id"], benchmark.schema["item_id"]])
    schema = schema.add("distance", LongType()).add("similarity", DoubleType()).add("first_word", LongType()).add("end_word", LongType())
    result = None
    for rows in item_blocks(benchmark):
        items = Items([r["item_id"] for r in rows], [r["text"] for r in rows], similarity, recall)
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            items, finder = shared.value, benchmark_words()
            for whole in batches:
                for batch in slices(whole):
                    raw, bounds = text_bytes(batch.column("text"))
                    starts, ends, firsts = symbols(finder, raw, bounds)
                    found = matches(finder.hashes(raw, starts, ends), firsts, items)
                    if found:
                        row, item, distance, low, high = zip(*found, strict=True)
                        near = [1 - d / len(items.words[i]) for d, i in zip(distance, item, strict=True)]
                        whose = pa.array([items.ids[i] for i in item], batch_type(items.ids))
                        columns = [batch.column("doc_id").take(pa.array(row)), whose, *map(pa.array, (distance, near, low, high))]
                        yield pa.RecordBatch.from_arrays(columns, names=schema.names)

        part = docs.select("doc_id", "text").mapInArrow(run, schema)
        result = part if result is None else result.unionByName(part)
    return result


def batch_type(ids: list):
    return pa.int64() if all(i is None or isinstance(i, int) for i in ids) else None
