"""Arrow batches as byte arrays, and words as 64-bit hashes, for the operators of this folder.

Every function works on slices of a bounded number of bytes; a text longer than that bound is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19  # texts handled at once; a worker holds some fifty bytes for each
HASH_BYTES = 1 << 20  # bytes whose powers are held at once
ROOT = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spreads 64-bit values over the whole range (a bijection for each seed)."""
    x = np.asarray(x, np.uint64) ^ np.uint64((seed * 0xD1342543DE82EF95 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of rows of about ``SLICE_BYTES`` of text."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
    block = (np.cumsum(sizes) - sizes) // SLICE_BYTES
    edges = np.flatnonzero(np.diff(block, prepend=-1)).tolist() + [batch.num_rows]
    for low, high in zip(edges, edges[1:], strict=False):
        yield batch.slice(low, high - low)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes and the bounds of its rows in them; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


class Words:
    """Finds words in bytes and hashes them.

    ``is_word`` tells for each byte value whether words hold it. A-Z count as a-z.
    """

    def __init__(self, is_word: np.ndarray):
        self.is_word = is_word
        lower = np.arange(256)
        lower[65:91] += 32
        self.values = mix(lower + 1, 7)
        self.powers, self.inverse = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) <= n:
            for name, root in (("powers", ROOT), ("inverse", pow(ROOT, -1, 2**64))):
                factors = np.full(n + 1, root, np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors))

    def find(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each word, and for each row the number of words before it (one more entry at the end)."""
        inside = self.is_word[raw]
        edges = bounds[(bounds < len(raw)) & (bounds >= 0)]
        before = np.empty_like(inside)
        before[1:], before[edges] = inside[:-1], False
        after = np.empty_like(inside)
        after[:-1] = inside[1:]
        after[bounds[bounds > 0] - 1] = False
        starts = np.flatnonzero(inside & ~before)
        return starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(starts, bounds)

    def hashes(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each word, from sums of powers over whole runs of bytes."""
        out, low = np.empty(len(starts), np.uint64), 0
        while low < len(starts):
            base = starts[low]
            high = max(low + 1, int(np.searchsorted(ends, base + HASH_BYTES, "right")))
            part = raw[base : ends[high - 1]]
            self._grow(max(HASH_BYTES, len(part)))
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(self.values[part] * self.powers[: len(part)], out=sums[1:])
            s, e = starts[low:high] - base, ends[low:high] - base
            out[low:high] = mix((sums[e] - sums[s]) * self.inverse[s])
            low = high
        return out


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """True for the byte values in the given inclusive ranges."""
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


def spaced_words() -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+``."""
    return Words(~byte_class((0x20, 0x20), (0x09, 0x0D)))


def shingles(words: np.ndarray, firsts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words within each row, and for each row the number of runs before it.

    A row with fewer words, but at least one, has the whole of them as its one run.
    """
    n = np.diff(firsts)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    ahead = np.concatenate(([0], np.cumsum(count)))
    at = np.repeat(firsts[:-1] - ahead[:-1], count) + np.arange(ahead[-1])
    last = np.repeat(firsts[1:], count)
    out = np.zeros(len(at), np.uint64)
    for k in range(size):
        there = at + k < last
        word = words[np.minimum(at + k, max(len(words) - 1, 0))] if len(words) else np.zeros(0, np.uint64)
        out = np.where(there, mix(out, k + 1) + word, out)
    return mix(out, 99), ahead
