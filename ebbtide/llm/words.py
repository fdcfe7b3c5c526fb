"""Words of UTF-8 texts over Arrow buffers: byte classes, bounds and 64-bit hashes, without a Python object per word.

All patterns used by the operators are classes of bytes (every character beyond ASCII counts as a letter
or as not white space), so words can be cut on the encoded text.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20  # texts handled at once in a task; a longer text is handled on its own

_BYTE = np.arange(256)
LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)
SPACED = ~np.isin(_BYTE, [32, 9, 10, 11, 12, 13])  # [^\x20\x09-\x0D]
LETTERS = ((_BYTE >= 48) & (_BYTE <= 57)) | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 128)  # of lower-cased text

_BASE, _BASE_INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every bit of a 64-bit value over all others."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(max(n, 1 << 16), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of codes[start:end] for every span, by one running sum over all codes."""
    power, inverse = _power(len(codes) + 1)
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * power[: len(codes)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    data: np.ndarray  # bytes of all texts, one after the other
    offsets: np.ndarray  # text i is data[offsets[i]:offsets[i + 1]]
    starts: np.ndarray  # bounds of the words in data
    ends: np.ndarray
    first: np.ndarray  # words of text i are first[i]:first[i + 1]
    hashes: np.ndarray  # of the words, lower-cased when asked for

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text each word is from."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the first words of all runs of ``size`` words inside a text, and the runs' hashes."""
        at = np.arange(len(self.starts))
        last = np.repeat(self.first[1:], self.counts)
        at = at[at + size <= last]
        return at, span_hashes(self.hashes, at, at + size)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def cut(texts: pa.Array, kept: np.ndarray = LETTERS, lower: bool = True) -> Words:
    """The words of every text: longest runs of bytes in the class ``kept``."""
    data, offsets = buffers(texts)
    shown = LOWER[data] if lower else data
    inside = kept[shown]
    n = len(data)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    bounds = offsets[(offsets > 0) & (offsets < n)]
    before[bounds] = False
    after[bounds - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets), span_hashes(_BYTE_CODE[shown], starts, ends))


def give_back() -> None:
    """Return freed memory to the system: Python workers live on between tasks, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of text each, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
            yield batch.slice(at, to - at)
            at = to
    give_back()


def strings(values: list[bytes] | list[str]) -> pa.Array:
    return pa.array(values, pa.string())
