"""How rare words are: hashed counts over all rows, at a fixed size.

Each word adds one per text unit it occurs in (a document, a line) to one of ``2**bits`` counters.  Shared counters
only overstate a count, so "at most one" is always true, and any order built from the counts is the same for all
rows, which is all that prefix filters need.  The counters' logarithms (one byte each, 16 MB at most whatever the
input) are the only thing that reaches the driver, to be broadcast from there.  Tasks' counters are added up in three
rounds of at most 64 at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 24
CHUNK_BITS = 16
STEPS = 8  # levels per doubling of a count
_SIZE = 1 << CHUNK_BITS
_FAN = 64
_ONE = np.uint32(1)  # of the counters' own type: numpy adds up others one by one through a cast

PART_SCHEMA = "chunk int, share int, slots binary, counts binary"
PART = pa.schema([("chunk", pa.int32()), ("share", pa.int32()), ("slots", pa.binary()), ("counts", pa.binary())])


def _packed(chunk: int, share: int, counts: np.ndarray) -> dict:
    """Counts of a chunk; without slots where most are there."""
    slots = np.flatnonzero(counts)
    if len(slots) > _SIZE // 4:
        return {"chunk": chunk, "share": share, "slots": b"", "counts": counts.astype(np.uint32).tobytes()}
    return {"chunk": chunk, "share": share, "slots": slots.astype(np.uint16).tobytes(),
            "counts": counts[slots].astype(np.uint32).tobytes()}


class Counter:
    """Counts of one task; give it the distinct word hashes of text units."""

    def __init__(self, bits: int = BITS) -> None:
        self.shift = np.uint64(64 - bits)
        self.counts = np.zeros(1 << bits, np.uint32)

    def add(self, hashes: np.ndarray) -> None:
        np.add.at(self.counts, (hashes >> self.shift).astype(np.int64), _ONE)

    def rows(self, partition: int) -> Iterator[dict]:
        for chunk in range(len(self.counts) // _SIZE):
            part = self.counts[chunk * _SIZE:(chunk + 1) * _SIZE]
            if part.any():
                yield _packed(chunk, partition // _FAN, part)

    def batches(self) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        for row in self.rows(TaskContext.get().partitionId()):
            yield pa.RecordBatch.from_pylist([row], PART)


def _total(table: pa.Table) -> np.ndarray:
    total = np.zeros(_SIZE, np.int64)
    for slots, counts in zip(table["slots"], table["counts"]):
        counts = np.frombuffer(counts.as_buffer(), np.uint32)
        if len(counts) == _SIZE and not len(slots.as_buffer()):
            total += counts
        else:
            total[np.frombuffer(slots.as_buffer(), np.uint16)] += counts
    return np.minimum(total, 2**32 - 1)


def _merge(table: pa.Table) -> pa.Table:
    chunk, share = (table[c][0].as_py() for c in ("chunk", "share"))
    return pa.Table.from_pylist([_packed(chunk, share // _FAN, _total(table))], PART)


def _level(table: pa.Table) -> pa.Table:
    total = _total(table)
    levels = np.zeros(len(total), np.uint8)
    many = total > 1
    levels[many] = np.minimum(255, 1 + np.floor(STEPS * np.log2(total[many] / 2))).astype(np.uint8)
    return pa.table({"chunk": pa.array([table["chunk"][0].as_py()], pa.int32()),
                     "levels": pa.array([levels.tobytes()], pa.binary())})


def levels(parts: DataFrame, bits: int = BITS) -> np.ndarray:
    """One byte for each counter: 0 for a count of at most one, then ``STEPS`` levels a doubling."""
    for _ in range(2):
        parts = parts.groupBy("chunk", "share").applyInArrow(_merge, PART_SCHEMA)
    rows = parts.groupBy("chunk").applyInArrow(_level, "chunk int, levels binary").select(
        F.col("chunk"), F.col("levels")).collect()  # 256 rows of 64 kB at most, whatever the input
    out = np.zeros(1 << bits, np.uint8)
    for chunk, level in rows:
        at = chunk << CHUNK_BITS
        out[at:at + len(level)] = np.frombuffer(bytes(level), np.uint8)
    return out


def level_of(levels: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return levels[(hashes >> np.uint64(65 - len(levels).bit_length())).astype(np.int64)]
