"""Language identification with bit-sliced Bloom filters over character n-grams."""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.batches import mix, slices

SIZE = 4  # characters of an n-gram
PAD = "\0\0"  # before and after each text, so that a single letter has an n-gram
PIECE_CHARS = 2_000_000  # a longer text is handled in pieces of that many characters
SAMPLE_PER_LANGUAGE = 2_000  # texts to learn a language from, about
LEAST_SHARE = 2e-5  # an n-gram is a language's if it makes up that share of its n-grams: 50,000 for each language at most
PROBES = 3  # rows that an n-gram sets
ROWS_PER_GRAM = 12
WORD = 64  # languages in one bit mask


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


@cache
def folding() -> np.ndarray:
    """For each code point its lower-case letter; a space for all that are no letters; 0 for the padding."""
    out = np.full(0x110000, 32, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            lower = char.lower()
            out[code] = ord(lower) if len(lower) == 1 else code
    out[0] = 0
    return out


def gram_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams, the index of the text each belongs to (ascending), and which texts have a letter."""
    pieces, owner = [], []
    for i, text in enumerate(texts):
        for low in range(0, max(len(text), 1), PIECE_CHARS):
            pieces.append(text[low : low + PIECE_CHARS])
            owner.append(i)
    codes = folding()[np.frombuffer((PAD + (PAD + PAD).join(pieces) + PAD).encode("utf-32-le", "surrogatepass"), np.uint32)]
    of = np.repeat(np.arange(len(pieces)), [len(p) + 2 * len(PAD) for p in pieces])
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    codes, of = codes[keep].astype(np.uint64), of[keep]
    owners = np.asarray(owner)
    letters = np.zeros(len(texts), bool)
    letters[owners[of[codes > 32]]] = True
    n = len(codes) - SIZE + 1
    h = np.zeros(n, np.uint64)
    for k in range(SIZE):
        h = h * np.uint64(0x100000001B3) + codes[k : k + n]
    inside = of[:n] == of[SIZE - 1 :]
    return mix(h[inside]), owners[of[:n][inside]], letters


class Filters:
    """One bit mask of languages in each row of a table; an n-gram sets its languages' bits in ``PROBES`` rows.

    The languages that hold an n-gram are the bits that all its rows have in common, with false positives: the share of
    a language's set bits to the power of ``PROBES``.
    """

    def __init__(self, languages: list[str], grams: dict[str, np.ndarray]):
        self.languages = languages
        most = max((len(g) for g in grams.values()), default=1)
        self.bits = max(10, int(np.ceil(np.log2(ROWS_PER_GRAM * most + 1))))
        self.tables = [np.zeros(1 << self.bits, np.uint64) for _ in range(0, len(languages), WORD)]
        for i, language in enumerate(languages):
            table, bit = self.tables[i // WORD], np.uint64(1 << i % WORD)
            for rows in self.rows(grams[language]):
                table[rows] |= bit
        filled = [np.mean((self.tables[i // WORD] >> np.uint64(i % WORD)) & np.uint64(1)) for i in range(len(languages))]
        self.false = np.asarray(filled) ** PROBES

    def rows(self, hashes: np.ndarray):
        """Two halves of the hash make the rows: first + k * second."""
        low, high = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
        for k in range(PROBES):
            yield (low + np.uint64(k) * high) & np.uint64((1 << self.bits) - 1)

    def shares(self, hashes: np.ndarray, owner: np.ndarray, n_texts: int) -> np.ndarray:
        """For each text and language the share of n-grams that the language holds, corrected for false positives."""
        total = np.bincount(owner, minlength=n_texts)
        out = np.zeros((n_texts, len(self.languages)))
        probes = list(self.rows(hashes))
        for w, table in enumerate(self.tables):
            mask = table[probes[0]]
            for rows in probes[1:]:
                mask &= table[rows]
            for i in range(w * WORD, min(len(self.languages), (w + 1) * WORD)):
                has = (mask >> np.uint64(i % WORD)) & np.uint64(1)
                out[:, i] = np.bincount(owner[has.astype(bool)], minlength=n_texts)
        seen = out / np.maximum(total, 1)[:, None]
        return np.clip((seen - self.false) / (1 - self.false), 0, 1)


def learn(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Filters:
    """Filters from the rows of ``docs`` (doc_id, text, lang) that may be learned from.

    Of each language about ``per_language`` rows are read, chosen by a hash of their id. The table's size is bounded by
    the number of languages and by ``1 / LEAST_SHARE`` n-grams for each.
    """
    allowed = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in allowed.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return Filters([], {})
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, per_language / counts[k]))])
    draw = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1_000_000)) / 1_000_000
    sample = allowed.where(draw < share[F.col("lang")]).select("lang", "text")

    def count(batches):
        totals: dict[str, list[np.ndarray]] = {}
        for whole in batches:
            for batch in slices(whole):
                hashes, owner, _ = gram_hashes(batch.column("text").to_pylist())
                langs = np.asarray(batch.column("lang").to_pylist(), object)
                for lang in set(langs):
                    part = hashes[(langs == lang)[owner]]
                    values, n = np.unique(part.view(np.int64), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(values), pa.string()), pa.array(values), pa.array(n, pa.int64())],
                        names=["lang", "gram", "n"],
                    )

    grams = sample.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    whole = grams.groupBy("lang").agg(F.sum("n").alias("total"))
    often = grams.join(F.broadcast(whole), "lang").where(F.col("n") >= LEAST_SHARE * F.col("total")).select("lang", "gram").toPandas()
    found = {lang: part["gram"].to_numpy(np.int64).view(np.uint64) for lang, part in often.groupby("lang")}
    return Filters(languages, {k: found.get(k, np.zeros(0, np.uint64)) for k in languages})


def predict(docs: DataFrame, filters: Filters, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to the ``keep`` columns.

    The language with the greatest corrected share of the text's n-grams is predicted, the first by name of equals; the
    share is the score. ``und`` with score 0 for null, for texts without a letter, and where nothing was learned. Equal
    texts have equal results.
    """
    from pyspark.sql.types import DoubleType, StringType

    schema = docs.select(*keep).schema.add("lang_pred", StringType()).add("score", DoubleType())
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches):
        model = shared.value
        for whole in batches:
            for batch in slices(whole, "__text"):
                texts = [t or "" for t in batch.column("__text").to_pylist()]
                if not texts:
                    continue
                hashes, owner, letters = gram_hashes(texts)
                if model.languages:
                    shares = model.shares(hashes, owner, len(texts))
                    best = shares.argmax(1)
                    names = np.where(letters, np.asarray(model.languages, object)[best], "und")
                    score = np.where(letters, shares[np.arange(len(texts)), best], 0.0)
                else:
                    names, score = np.full(len(texts), "und", object), np.zeros(len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(score, pa.float64())], names=schema.names
                )

    return docs.select(*keep, docs[text].alias("__text")).mapInArrow(run, schema)
