"""Spelling variants: words of one edit between them, found by dynamic programming along sorted lists.

A sorted list is scanned for each of its words. Rows of the edit matrix, three cells wide as only one edit is allowed, are kept for every
prefix of the word just read; the next word goes on from the row of the prefix that both share. Once a row has no cell
below two, no word with that prefix can be near, and the scan jumps to the end of their range.

The vocabulary is split into lists that fit a task. Of two words with one edit between them, the shorter of ``m`` letters, either the
first half is equal or the last half is; so a list holds the words for which ``m``, that half and its letters are equal, and words stand in
up to four lists. A list that is too long is split again, by halves of what is not yet equal, until it is short enough or a
single letter is free, which a bounded number of words can share. A pair counts in the one list that its own halves lead to.

Words are counted over all documents: null texts have none, and a row without an id counts as one of an id without digits.
Repeated rows count again. An empty table, or one without frequent words, gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.batches import slices
from tillstream.llm.components import saved

LETTERS = "A-Za-zÀ-ÿ"
SHORTEST, RAREST = 6, 5  # letters and occurrences that a word has at least
EDITED = 199  # one in so many runs, by its checksum, has a letter removed
RATIO = 5  # times more often than a word that its form occurs
LIST = 20_000  # words of a list that one task holds; more are split while they can be
HELD = 500_000  # distinct words a task counts before it passes them on
LAST = "\uffff"  # after all letters
SMALL = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
FOLLOWS = 32  # steps in a chain of forms at most: each has five times the count of the one before, and counts are longs


def words_of(doc_id, text: str) -> Counter:
    """The words of a text and how often each occurs."""
    counts = Counter()
    for run, n in Counter(re.findall(f"[{LETTERS}]{{{SHORTEST},}}", text)).items():
        run = run.translate(SMALL)
        h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
        if h % EDITED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= SHORTEST:
            counts[run] += n
    return counts


def vocabulary(docs: DataFrame) -> DataFrame:
    """Rows (word, n) of the words that are frequent enough. Counts are added up in each task before they meet."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            for part in slices(batch):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    if text:
                        counts.update(words_of(doc_id, text))
                    if len(counts) > HELD:
                        yield pa.RecordBatch.from_pydict({"word": list(counts), "n": list(counts.values())})
                        counts = Counter()
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})

    found = docs.select("doc_id", "text").mapInArrow(scan, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= RAREST)


def halves(rows: DataFrame) -> DataFrame:
    """Each row twice: with the first half of what is free in it fixed, and with the last half.

    ``before`` and ``after`` letters of a word are fixed at its ends; ``free`` are those between them in the shorter word of a pair.
    """
    first = F.call_function("div", F.col("free"), F.lit(2)).cast("int")
    side = F.explode(F.array(F.lit("first"), F.lit("last"))).alias("side")
    split = rows.select("*", first.alias("_first"), side)
    is_first = F.col("side") == "first"
    fixed = F.when(is_first, F.col("_first")).otherwise(F.col("free") - F.col("_first"))
    return split.select(
        "word", "n", "m",
        (F.col("before") + F.when(is_first, fixed).otherwise(0)).alias("before"),
        (F.col("after") + F.when(is_first, 0).otherwise(fixed)).alias("after"),
        (F.col("free") - fixed).alias("free"),
        F.concat("way", F.substring("side", 1, 1)).alias("way"),
    )


def list_key() -> Column:
    ends = (F.col("word").substr(F.lit(1), F.col("before")), F.col("word").substr(F.length("word") - F.col("after") + 1, F.col("after")))
    return F.xxhash64("m", "way", *ends)


def lists(words: DataFrame, most: int = LIST) -> DataFrame:
    """The words in their lists: word, n, m, before, after, way (the halves chosen), key."""
    shorter = F.explode(F.filter(F.array(F.length("word"), F.length("word") - 1), lambda m: m >= SHORTEST)).alias("m")
    whole = words.select("word", "n", shorter).select(
        "*", F.lit(0).alias("before"), F.lit(0).alias("after"), F.col("m").alias("free"), F.lit("").alias("way")
    )
    rows, ready = saved(halves(whole).withColumn("key", list_key()), "lists"), []
    while True:
        long = rows.where("free > 1").groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > most)
        long = saved(long.select("key"), "long-lists")
        if long.isEmpty():
            break
        ready.append(rows.join(long, "key", "left_anti"))
        rows = saved(halves(rows.join(long, "key", "left_semi")).withColumn("key", list_key()), "lists")
    for more in ready:
        rows = rows.unionByName(more)
    return rows


def shared(a: str, b: str) -> int:
    """Letters that two texts have in common at their beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def near_in_list(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Pairs of places in a sorted list whose texts are one edit apart, the lesser place first."""
    common = [0, *(shared(a, b) for a, b in zip(texts, texts[1:], strict=False))]
    for q, query in enumerate(texts):
        last = len(query)
        rows = [(9, 0, 1)]  # of the prefix of each length: the cells left of, on and right of the diagonal
        at, keep = q + 1, common[q + 1] if q + 1 < len(texts) else 0
        while at < len(texts):
            text = texts[at]
            depth = min(keep, len(rows) - 1)
            left, on, right = rows[depth]
            dead = 0
            for i in range(depth, len(text)):
                c = text[i]
                left = min(on + 1, left + (i < 1 or i > last or query[i - 1] != c))
                on = min(on + (i >= last or query[i] != c), right + 1, left + 1)
                right = min(right + (i + 1 >= last or query[i + 1] != c), on + 1)
                del rows[i + 1 :]
                rows.append((left, on, right))
                if left > 1 and on > 1 and right > 1:
                    dead = i + 1
                    break
            else:
                del rows[len(text) + 1 :]
                wide = last - len(text)
                if -1 <= wide <= 1 and (left, on, right)[wide + 1] == 1:
                    yield q, at
            if dead:
                to = bisect_left(texts, text[:dead] + LAST, at + 1)
                keep = shared(text[: dead - 1], texts[to]) if to < len(texts) else 0
                at = to
            else:
                at += 1
                keep = common[at] if at < len(texts) else 0


def way_of(a: str, b: str, steps: int) -> str:
    """The halves that a pair's own letters lead to: the first where it is equal, else the last."""
    before = after = 0
    free, way = min(len(a), len(b)), ""
    for _ in range(steps):
        first = free // 2
        if a[before : before + first] == b[before : before + first]:
            before, free, way = before + first, free - first, way + "f"
        else:
            after, free, way = after + free - first, first, way + "l"
    same_end = not after or a[len(a) - after :] == b[len(b) - after :]
    return way if a[:before] == b[:before] and same_end else ""


def near_words(words: DataFrame, most: int = LIST) -> DataFrame:
    """For each word that has any: n_near, how many words are near to it, and best, of these the most frequent (form_n, form)."""
    rows = lists(words, most).repartition("key")
    middle = F.col("word").substr(F.col("before") + 1, F.length("word") - F.col("before") - F.col("after"))
    rows = rows.select("key", "way", "m", middle.alias("middle"), "word", "n").sortWithinPartitions("key", "middle", "word")

    def sweep(held: list[tuple]) -> dict[str, list]:
        found: dict[str, list] = {}
        start = 0
        while start < len(held):  # two keys may have one hash: lists of different ways or lengths are scanned apart
            kind = held[start][:2]
            group = [r for r in held[start:] if r[:2] == kind]
            rest = [r for r in held[start:] if r[:2] != kind]
            held, start = held[:start] + group + rest, start + len(group)
            for a, b in near_in_list([r[2] for r in group]):
                (_, _, _, one, n_one), (_, _, _, two, n_two) = group[a], group[b]
                if min(len(one), len(two)) == kind[1] and way_of(one, two, len(kind[0])) == kind[0]:
                    for word, other, n in ((one, two, n_two), (two, one, n_one)):
                        near = found.setdefault(word, [0, -n, other])
                        near[0] += 1
                        if (-n, other) < (near[1], near[2]):
                            near[1:] = -n, other
        return found

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(found: dict[str, list]) -> pa.RecordBatch:
            counts, lows, forms = zip(*found.values(), strict=True)
            return pa.RecordBatch.from_pydict({"word": list(found), "n_near": list(counts), "less": list(lows), "form": list(forms)})

        key, held = None, []
        for batch in batches:
            for k, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key and held:
                    if len(held) > 1 and (found := sweep(held)):
                        yield batch_of(found)
                    held = []
                key = k
                held.append(tuple(row))
        if len(held) > 1 and (found := sweep(held)):
            yield batch_of(found)

    found = rows.mapInArrow(scan, "word string, n_near bigint, less bigint, form string")
    best = F.min(F.struct("less", "form")).alias("best")
    near = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return near.select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form"))


def variants(docs: DataFrame, most: int = LIST) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n): the frequent words, the form each is a variant of, and the last of the chain of forms."""
    words = saved(vocabulary(docs), "vocabulary")
    known = words.join(near_words(words, most), "word", "left")
    is_form = F.col("form_n") >= RATIO * F.col("n")
    known = saved(
        known.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n"),
        ),
        "forms",
    )
    chain = saved(known.where("form is not null").select("word", F.col("form").alias("root")), "chain")
    length = 1
    while length < FOLLOWS:
        further = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if chain.join(further, "root", "left_semi").isEmpty():
            break
        chain = saved(chain.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "chain")
        length *= 2
    result = known.join(chain, "word", "left")
    return result.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
