"""Words of many texts at once: positions and 64-bit hashes over the byte buffer of an Arrow column.

A word is a run of bytes other than space and \\x09-\\x0D, so that words of UTF-8 bytes are those of characters. A word's
hash is a polynomial over its bytes modulo 2**64, mixed; two different words share one with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is handled alone, whole.
SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUES = mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_LOWER_VALUES = _VALUES[_LOWER]


def powers(base: np.uint64, n: int, name: str) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept for the next call."""
    if name not in _powers or len(_powers[name]) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        kept = np.multiply.accumulate(steps)
        if len(kept) > 4 * SLICE_BYTES:
            return kept[:n]
        _powers[name] = kept
    return _powers[name][:n]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Sums of values[i] * base**i before each position."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(_BASE, len(values), "up"), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hash of each span [start, end) of what prefix_hash has summed."""
    down = powers(_INVERSE, len(prefix), "down")
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


@dataclass
class Words:
    """Words of some texts: byte buffer, texts' offsets in it, each word's text and byte span."""

    data: np.ndarray
    offsets: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def hashes(self, lower: bool) -> np.ndarray:
        prefix = prefix_hash((_LOWER_VALUES if lower else _VALUES)[self.data])
        return span_hash(prefix, self.start, self.end)

    def bounds(self) -> np.ndarray:
        """Index of the first word of each text, and of the end."""
        return np.searchsorted(self.text, np.arange(len(self.offsets)))


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts one after another and the offsets of each; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of whole rows of about `limit` bytes in `column`."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = buffer(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows, first + 20_000)
            yield batch.slice(first, last - first)
            first = last


def split_words(texts: pa.Array) -> Words:
    data, offsets = buffer(texts)
    inside = _IS_WORD[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(data, offsets, np.searchsorted(offsets, start, side="right") - 1, start, end)
