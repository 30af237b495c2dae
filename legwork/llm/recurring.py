"""Which hashed keys recur, as a Bloom filter of fixed size that tasks can ask.

The filter never denies a key that recurs often enough. Others that it lets through are
sorted out by the exact counts behind it, so it saves work and changes no result. With far
more recurring keys than ``BITS`` / 16 it lets more through.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26
_TURNS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
#: Keys combined in a task before they leave it, and rows that a task adds up.
COMBINED, ROWS_PER_TASK = 1 << 21, 4_000_000
#: Rows of a batch that leaves a task; the receiver holds a whole one outside its heap.
BATCH_ROWS = 1 << 16


def spots(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    shift = np.uint64(64 - (bits.bit_length() - 1))
    return [(keys.view(np.uint64) * turn) >> shift for turn in _TURNS]


def taken(held: list[np.ndarray]) -> np.ndarray:
    """The arrays of a list as one in order; the list is emptied, so only one copy stays."""
    found = np.concatenate(held)
    held.clear()
    found.sort()
    return found


def runs_of(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal values starts, and its length."""
    new = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    starts = np.flatnonzero(new)
    return starts, np.diff(starts, append=len(ordered))


def in_batches(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows in batches of bounded size."""
    for first in range(0, len(rows), BATCH_ROWS):
        yield rows.slice(first, BATCH_ROWS)


def counted(streams: Iterable[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """``key, n`` of the hashed keys, combined as far as memory allows."""
    held, size = [], 0

    def flush():
        keys = taken(held)
        starts, n = runs_of(keys)
        return in_batches(pa.record_batch([pa.array(keys[starts].view(np.int64)), pa.array(n)], ["key", "n"]))

    for keys in streams:
        held.append(keys)
        size += len(keys)
        if size > COMBINED:
            yield from flush()
            size = 0
    if held:
        yield from flush()


def often(counts: DataFrame, least: int, rows: int) -> DataFrame:
    """Keys counted ``least`` times, of about so many rows ``key, n``.

    The tasks have combined their counts, so rows are dealt out by key at once; each task
    gets a bounded number and adds them up in one sort.
    """

    def add(batches):
        held = [(b.column("key").to_numpy(), b.column("n").to_numpy()) for b in batches]
        if not held:
            return
        keys, n = (np.concatenate(part) for part in zip(*held))
        found, codes = np.unique(keys, return_inverse=True)
        total = np.zeros(len(found), np.int64)
        np.add.at(total, codes, n)
        yield pa.record_batch([pa.array(found[total >= least])], ["key"])

    dealt = counts.select("key", "n").repartition(max(8, -(-rows // ROWS_PER_TASK)), "key")
    return dealt.mapInArrow(add, "key bigint")


def recurring(keys: DataFrame, bits: int = BITS) -> np.ndarray:
    """The filter of the keys; at most ``bits / 64`` rows reach the driver."""

    def place(batches):
        for batch in batches:
            bit = np.concatenate(spots(batch.column(0).to_numpy(), bits)).astype(np.int64)
            yield pa.record_batch([pa.array(bit >> 6), pa.array(np.left_shift(np.int64(1), bit & 63))], ["word", "mask"])

    placed = keys.select("key").mapInArrow(place, "word bigint, mask bigint")
    table = placed.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    found = np.zeros(bits // 64, np.uint64)
    found[table.column("word").to_numpy()] = table.column("mask").to_numpy().view(np.uint64)
    return found


def may_recur(keys: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Whether each key may be in the filter."""
    found = np.ones(len(keys), bool)
    for spot in spots(keys, len(words) * 64):
        found &= (words[spot >> np.uint64(6)] >> (spot & np.uint64(63))) & np.uint64(1) == 1
    return found
