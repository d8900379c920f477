"""Blocked Bloom filters of 64-bit keys, built by Spark and probed by numpy.

A filter is a table of blocks of 512 bits; a key sets five bits of one block. Its size is bounded by a parameter, not by
the number of keys: past that, more keys pass that were never put in, and none that was is refused.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specflow.llm.arrays import mix

#: Words of 64 bits in a block, bits set for a key, and bits of the filter for each key where the bound allows them.
BLOCK_WORDS, BITS_SET, BITS_A_KEY = 8, 5, 16

_STEP = 1 << 16


def blocks_for(keys: int, most_bytes: int) -> int:
    """How many blocks serve so many keys within the bound."""
    return max(1, min(-(-keys * BITS_A_KEY // (64 * BLOCK_WORDS)), most_bytes // (8 * BLOCK_WORDS)))


def _bits(keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each bit of a key: its word within the block, and the bit's mask."""
    draws = mix(keys ^ np.uint64(0xA0761D6478BD642F))
    for k in range(BITS_SET):
        draw = (draws >> np.uint64(9 * k)).astype(np.int64)
        yield draw >> 6 & (BLOCK_WORDS - 1), np.uint64(1) << (draw & 63).astype(np.uint64)


def block_of(keys: np.ndarray, n_blocks: np.ndarray | int) -> np.ndarray:
    """The key's block among so many: its high 32 bits, scaled."""
    return ((keys >> np.uint64(32)) * np.asarray(n_blocks, np.uint64) >> np.uint64(32)).astype(np.int64)


def contains(table: np.ndarray, keys: np.ndarray, blocks: np.ndarray | None = None) -> np.ndarray:
    """Which keys may be in the filter (``blocks`` names their blocks where the table has shards)."""
    found = np.ones(len(keys), bool)
    for begin in range(0, len(keys), _STEP):
        own = slice(begin, begin + _STEP)
        at = (block_of(keys[own], len(table)) if blocks is None else blocks[own]) * BLOCK_WORDS
        flat, some = table.reshape(-1), found[own]
        for word, mask in _bits(keys[own]):
            some &= flat[at + word] & mask != 0
    return found


_WORDS = [f"w{i}" for i in range(BLOCK_WORDS)]


#: The keys of a batch and their blocks; keys in blocks below zero are left out.
Placed = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]


def _as_given(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("key").to_numpy().view(np.uint64), batch.column("block").to_numpy()


def _partial(n_blocks: int, placed: Placed):
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: np.ndarray | None = None
        for batch in batches:
            table = np.zeros((n_blocks, BLOCK_WORDS), np.uint64) if table is None else table
            keys, blocks = placed(batch)
            if len(blocks) and blocks.min() < 0:
                keys, blocks = keys[blocks >= 0], blocks[blocks >= 0]
            for word, mask in _bits(keys):
                np.bitwise_or.at(table, (blocks, word), mask)
        if table is not None:
            used = np.flatnonzero(table.any(axis=1))
            for begin in range(0, len(used), _STEP):
                some = used[begin : begin + _STEP]
                columns = [pa.array(some), *(pa.array(table[some, i].view(np.int64)) for i in range(BLOCK_WORDS))]
                yield pa.RecordBatch.from_arrays(columns, names=["block", *_WORDS])

    return fill


def filter_of(keys: DataFrame, n_blocks: int, placed: Placed = _as_given) -> np.ndarray:
    """The table of a filter of the frame's ``key`` (long) in ``block`` (long): tasks fill their own, Spark unites them.

    Keys that numpy derives come from ``placed``, in the same pass: one more would have a second worker in each task, and
    workers that have no more work stay in an executor's memory for a while. What reaches the driver is the table itself, ``n_blocks`` blocks at most.
    """
    schema = "block long, " + ", ".join(f"{w} long" for w in _WORDS)
    parts = keys.mapInArrow(_partial(n_blocks, placed), schema)
    found = parts.groupBy("block").agg(*(F.bit_or(w).alias(w) for w in _WORDS)).toArrow()
    table = np.zeros((n_blocks, BLOCK_WORDS), np.uint64)
    at = found.column("block").to_numpy()
    for i, word in enumerate(_WORDS):
        table[at, i] = found.column(word).to_numpy().view(np.uint64)
    return table
