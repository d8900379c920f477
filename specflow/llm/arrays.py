"""Texts as flat numpy arrays: their bytes, their words, and hashes of words and of runs of words.

Everything works on a slice of a batch of at most a few megabytes, so the memory of a
task doesn't depend on how many rows a batch has. One text is the least a slice holds.
Words are ``[^\\x20\\x09-\\x0D]+``; a null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 21

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers after which all bits depend on all bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_STEP = 0x9E3779B97F4A7C15
_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_STEP))
_INVERSE = pow(_STEP, -1, 1 << 64)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse, at least ``n`` of them."""
    global _powers, _inverses
    if len(_powers) < n:
        _powers = np.full(n, _STEP, np.uint64)
        _powers[0] = 1
        np.cumprod(_powers, out=_powers)
        _inverses = np.full(n, _INVERSE, np.uint64)
        _inverses[0] = 1
        np.cumprod(_inverses, out=_inverses)
    return _powers, _inverses


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of ``codes[start:end]`` for each span; equal spans have equal hashes."""
    powers, inverses = _tables(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * powers[: len(codes)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))


def run_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """The hash of each ``k`` consecutive codes; empty if there are fewer."""
    if len(codes) < k:
        return np.zeros(0, np.uint64)
    starts = np.arange(len(codes) - k + 1)
    return span_hashes(codes, starts, starts + k)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each text begins (one more offset than texts)."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts together have at most ``most`` bytes, one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


@dataclass
class Words:
    """The words of some texts, text after text."""

    codes: np.ndarray  # a hash of each word
    offsets: np.ndarray  # of each text's first word; one more than texts

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    @property
    def texts(self) -> np.ndarray:
        """The number of the text each word belongs to."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    @property
    def wholes(self) -> np.ndarray:
        """A hash of all words of each text."""
        return span_hashes(self.codes, self.offsets[:-1], self.offsets[1:])

    def runs_from(self, k: int) -> np.ndarray:
        """For each of the first ``len(codes) - k + 1`` words: do ``k`` words from it stay in its text?"""
        n = max(0, len(self.codes) - k + 1)
        last = np.repeat(self.offsets[1:] - k, self.counts)[:n]
        return np.arange(n) <= last


def words_of(texts: pa.Array) -> Words:
    data, offsets = text_bytes(texts)
    if not len(data):
        return Words(np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(span_hashes(_BYTE_CODES[data], starts, stops), np.searchsorted(starts, offsets))
