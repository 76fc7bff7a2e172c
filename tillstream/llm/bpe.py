"""Token counts by byte-pair merging with a heap of pairs and a linked list of symbols; no identifiers are made."""

from __future__ import annotations

import json
import re
from functools import cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType

from tillstream.llm.batches import slices, text_bytes

CACHED_PIECES = 400_000  # pieces whose counts a worker remembers
CACHED_BYTES = 64  # of a piece at most
# White space of the Unicode standard. Fixed values.
SPACE = "\t-\r \x85\xa0  -     　"
# Letters and numbers below U+0250, where texts of western scripts stay.
LATIN_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
LATIN_NUMBERS = "0-9²³¹¼-¾"


def split_pattern(letters: str, numbers: str) -> str:
    """The split before merging: contractions, then runs of letters, numbers or others after one space, then spaces."""
    other = rf"[^{SPACE}{letters}{numbers}]+"
    return rf"'(?:s|t|re|ve|m|ll|d)| ?[{letters}]+| ?[{numbers}]+| ?{other}|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


class Pieces(dict):
    """Token counts by piece; a missing piece is merged, and remembered while there is room."""

    def __init__(self, vocabulary: str):
        import regex

        with open(vocabulary, encoding="utf8") as file:
            spec = json.load(file)
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, self.added))) if self.added else None
        shown = byte_characters()
        bytes_of = {c: b for b, c in enumerate(shown)}
        decode = lambda token: bytes(bytes_of[c] for c in token)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        ids = {bytes([b]): b for b in range(256)}
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (left, right) in enumerate(merges):
            a, b = decode(left), decode(right)
            self.rank.setdefault((ids[a], ids[b]), (rank, ids.setdefault(a + b, len(ids))))
        self.latin = re.compile(split_pattern(LATIN_LETTERS, LATIN_NUMBERS))
        self.any = regex.compile(split_pattern(r"\p{L}", r"\p{N}"))
        self.beyond = re.compile("[^\x00-ɏ]")
        self.room = CACHED_PIECES

    def __missing__(self, piece: str) -> int:
        raw = piece.encode("utf8")
        count = len(raw) - merges_of(raw, self.rank)
        if len(raw) <= CACHED_BYTES:
            if len(self) >= self.room:
                self.clear()
            self[piece] = count
        return count

    def plain(self, text: str) -> int:
        pattern = self.any if self.beyond.search(text) else self.latin
        return sum(map(self.__getitem__, pattern.findall(text)))

    def count(self, text: str) -> int:
        """Tokens of a text; a special token's string is one token, and texts beside it are split on their own."""
        if self.special is None or not self.special.search(text):
            return self.plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self.plain(p) for p in parts if p)


def byte_characters() -> list[str]:
    """The character that stands for each byte in the vocabulary's file: printable ones for themselves, the rest from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


def merges_of(raw: bytes, rank: dict[tuple[int, int], tuple[int, int]]) -> int:
    """How many merges the bytes allow: the lowest-ranked adjacent pair first, the leftmost of equals."""
    symbols = list(raw)
    n = len(symbols)
    heap = [(*found, i) for i in range(n - 1) if (found := rank.get((symbols[i], symbols[i + 1])))]
    if not heap:
        return 0
    heap = [(order, i, made) for order, made, i in heap]
    heapify(heap)
    following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
    done = 0
    while heap:
        order, i, made = heappop(heap)
        j = following[i]
        if symbols[i] < 0 or j >= n or (now := rank.get((symbols[i], symbols[j]))) is None or now[0] != order:
            continue  # one of the two has been merged meanwhile
        symbols[i], symbols[j] = made, -1
        done += 1
        k = following[i] = following[j]
        if k < n:
            previous[k] = i
            if found := rank.get((made, symbols[k])):
                heappush(heap, (found[0], i, found[1]))
        h = previous[i]
        if h >= 0 and (found := rank.get((symbols[h], made))):
            heappush(heap, (found[0], h, found[1]))
    return done


@cache
def pieces(vocabulary: str) -> Pieces:
    return Pieces(vocabulary)


def token_counts(
    docs: DataFrame, vocabulary: str, limit: int = 1024, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """Adds ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of each whole text to the ``keep`` columns.

    ``vocabulary``: path of a byte-level merge file, which every executor has. A null text counts as empty: no bytes,
    no tokens. Each row stands for itself: repeated rows give repeated results.
    """
    schema = docs.select(*keep).schema.add("n_bytes", LongType()).add("n_tokens", LongType()).add("over_limit", BooleanType())

    def run(batches):
        table = pieces(vocabulary)
        for whole in batches:
            for batch in slices(whole, "__text"):
                data, bounds = text_bytes(batch.column("__text"))
                counts = [table.count(t) if t else 0 for t in batch.column("__text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[:-1], pa.array(bounds[1:] - bounds[:-1], pa.int64()), pa.array(counts, pa.int64()),
                        pa.array([c > limit for c in counts], pa.bool_()),
                    ],
                    names=schema.names,
                )

    return docs.select(*keep, docs[text].alias("__text")).mapInArrow(run, schema)
