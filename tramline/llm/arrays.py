"""Words of many texts at once, as NumPy arrays over one block of UTF-8 bytes.

A word is a run of bytes outside 0x20 and 0x09-0x0D. Words never cross texts.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20  # texts worked on together; one longer text is a block alone
PIECE_BYTES = 1 << 20  # bytes hashed in one go

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True

WORD_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
GRAM_BASE = 0xD1342543DE82EF95


def worker_state() -> dict:
    """A dictionary that lives as long as the Python worker.

    Functions sent by value get new globals in each task; tokenizers and the
    like are kept here instead.
    """
    name = "_tramline_worker"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
        sys.modules[name].state = {}
    return sys.modules[name].state


def blocks(
    batch: pa.RecordBatch, column: str, block_bytes: int = BLOCK_BYTES
) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Runs of rows with the bytes of their texts and the rows' offsets in them.

    NULL counts as the empty text.
    """
    texts = batch.column(column).cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, where, held = texts.buffers()
    n = len(texts)
    offsets = np.frombuffer(where, np.int64, n + 1 + texts.offset)[texts.offset :]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + block_bytes, "right")) - 1
        last = min(max(last, first + 1), n)
        lo, hi = int(offsets[first]), int(offsets[last])
        yield slice(first, last), data[lo:hi], offsets[first : last + 1] - lo
        first = last


def find_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Byte starts and ends of all words, and each text's offset among the words."""
    n = len(data)
    inside = ~SEPARATOR[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(n, dtype=bool)
    after = np.empty(n, dtype=bool)
    if n:
        before[0], after[-1] = False, False
        before[1:], after[:-1] = inside[:-1], inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def powers(base: int, n: int) -> np.ndarray:
    """base^0 … base^(n-1) modulo 2^64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def range_hashes(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, base: int) -> np.ndarray:
    """A 64-bit hash of values[lo:hi] for each pair, from one running sum."""
    if not len(lo):
        return np.zeros(0, np.uint64)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=total[1:])
    back = powers(inverse(base), len(values) + 1)
    return mix((total[hi] - total[lo]) * back[lo] + (hi - lo).astype(np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word; bytes are summed in pieces of bounded size."""
    spread = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(WORD_BASE))
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = int(np.searchsorted(ends, starts[first] + PIECE_BYTES, "right"))
        last = max(last, first + 1)
        at = int(starts[first])
        part = spread[data[at : int(ends[last - 1])]]
        out[first:last] = range_hashes(part, starts[first:last] - at, ends[first:last] - at, WORD_BASE)
        first = last
    return out


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of each ``size`` consecutive words, over text borders too."""
    n = max(len(words) - size + 1, 0)
    at = np.arange(n)
    return range_hashes(words, at, at + size, GRAM_BASE)


def ranges(lo: np.ndarray, length: np.ndarray) -> np.ndarray:
    """lo[0], lo[0]+1, … for length[0] numbers, then the same from lo[1], and so on."""
    total = int(length.sum())
    first = np.cumsum(length) - length
    return np.repeat(lo - first, length) + np.arange(total)


def row_of(offsets: np.ndarray) -> np.ndarray:
    """The row that each of offsets[-1] items belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
