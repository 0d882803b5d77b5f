"""A fixed-size count sketch over all fingerprints of a table.

Each task adds its fingerprints into 2**20 counters; slices of the tasks' counters are summed in
two levels of groups. The result orders fingerprints rare first: a class by how far the counter
stands above the mean, then the fingerprint. Any such order is valid for the filters that use
it; the sketch only makes it a good one. Its size never grows with the data.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 20
SLICES = 16
SLICE = (1 << BITS) // SLICES
SCHEMA = "slice int, part long, counts binary"


class Counter:
    """Counters of one task."""

    def __init__(self) -> None:
        self.counts = np.zeros(1 << BITS, np.int64)
        self.waiting: list[np.ndarray] = []
        self.size = 0

    def add(self, prints: np.ndarray) -> None:
        self.waiting.append((prints >> np.uint64(64 - BITS)).astype(np.int32))
        self.size += len(prints)
        if self.size > 1 << 20:
            self.flush()

    def flush(self) -> None:
        if self.waiting:
            self.counts += np.bincount(np.concatenate(self.waiting), minlength=1 << BITS)
            self.waiting, self.size = [], 0

    def slices(self) -> Iterator[tuple[int, bytes]]:
        self.flush()
        for i in range(SLICES):
            yield i, pack(self.counts[i * SLICE : (i + 1) * SLICE])


def pack(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(blob), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def _sum(key: tuple, t: pa.Table) -> pa.Table:
    total = np.int64(0)
    for blob in t["counts"]:
        total = total + unpack(blob.as_py())
    return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([0], pa.int64()), "counts": pa.array([pack(total)], pa.binary())})


def total(parts: DataFrame, groups: int = 64, size: int = 1 << BITS) -> np.ndarray:
    """The sums of all tasks' counters, ``size`` of them; parts has slice, part and counts."""
    dealt = parts.select("slice", F.pmod("part", F.lit(groups)).alias("part"), "counts")
    some = dealt.groupBy("slice", "part").applyInArrow(_sum, SCHEMA)
    rows = some.groupBy("slice").applyInArrow(_sum, SCHEMA).collect()  # SLICES rows, 8 MB at most
    out = np.zeros(size, np.int64)
    for r in rows:
        counts = unpack(bytes(r["counts"]))
        out[r["slice"] * len(counts) : (r["slice"] + 1) * len(counts)] = counts
    return out


def classes(counts: np.ndarray) -> np.ndarray:
    """Class by counter: 0 within the usual spread, then one more for each doubling above it."""
    mean = counts.mean()
    step = 5 * np.sqrt(mean) + 8
    over = (counts - mean) / step
    return np.where(over < 1, 0, np.minimum(np.log2(np.maximum(over, 1)) + 1, 60)).astype(np.uint8)


def order_key(prints: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Sort key, rare first: class in the top byte, then 56 bits of the fingerprint."""
    top = cls[(prints >> np.uint64(64 - BITS)).astype(np.int32)].astype(np.uint64)
    return (top << np.uint64(56)) | (prints >> np.uint64(8))
