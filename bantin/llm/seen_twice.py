"""A pair of Bloom filters over a distributed stream of hashes: seen once, seen at least twice.

Each task fills its own pair; a hash found in the task's first filter goes into its second. Pairs
merge without the hashes: what is in both first filters was seen twice, so
once = a.once | b.once and twice = a.twice | b.twice | (a.once & b.once).
The size is fixed by `bits_log2`, so the pair may be broadcast whatever the corpus. A fuller filter
only lets more hashes through to the exact step that follows; it never loses a repeated one.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from bantin.llm.common import mixed, release

# 2^27 bits: 16 MB a filter.
BITS_LOG2 = 27
_PROBES = 2
_BLOCK = 1 << 16  # bytes of filter in one row


def _places(hashes: np.ndarray, bits_log2: int) -> np.ndarray:
    """Bit positions, one row per probe."""
    mask = np.uint64((1 << bits_log2) - 1)
    second = mixed(hashes ^ np.uint64(0x5851F42D4C957F2D))
    return np.stack([hashes & mask, second & mask])[:_PROBES]


def _has(filter_: np.ndarray, places: np.ndarray) -> np.ndarray:
    bits = np.uint8(1) << (places & np.uint64(7)).astype(np.uint8)
    return ((filter_[places >> np.uint64(3)] & bits) != 0).all(axis=0)


def _put(filter_: np.ndarray, places: np.ndarray) -> None:
    np.bitwise_or.at(filter_, (places >> np.uint64(3)).ravel(), (np.uint8(1) << (places & np.uint64(7)).astype(np.uint8)).ravel())


def _blocks(once: np.ndarray, twice: np.ndarray) -> Iterator[pa.RecordBatch]:
    size = min(_BLOCK, len(once))
    for b, (x, y) in enumerate(zip(once.reshape(-1, size), twice.reshape(-1, size))):
        if x.any():
            row = [[b], [zlib.compress(x, 1)], [zlib.compress(y, 1)]]
            yield pa.RecordBatch.from_arrays([pa.array(row[0], pa.int32()), pa.array(row[1], pa.binary()), pa.array(row[2], pa.binary())], ["block", "once", "twice"])


class SeenTwice:
    """The filter of hashes seen at least twice, as workers receive it."""

    def __init__(self, bits: bytes, bits_log2: int) -> None:
        self.bits, self.bits_log2 = bits, bits_log2

    def has(self, hashes: np.ndarray) -> np.ndarray:
        if not len(hashes):
            return np.empty(0, bool)
        return _has(np.frombuffer(self.bits, np.uint8), _places(hashes, self.bits_log2))


class Pair:
    """One task's filters of hashes seen once and twice."""

    def __init__(self, bits_log2: int = BITS_LOG2) -> None:
        size = 1 << max(bits_log2 - 3, 0)
        self.bits_log2, self.once, self.twice = bits_log2, np.zeros(size, np.uint8), np.zeros(size, np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        keys, counts = np.unique(hashes, return_counts=True)
        if len(keys):
            places = _places(keys, self.bits_log2)
            repeated = (counts > 1) | _has(self.once, places)
            _put(self.twice, places[:, repeated])
            _put(self.once, places)

    def blocks(self) -> Iterator[pa.RecordBatch]:
        """The pair as rows (block, once, twice)."""
        return _blocks(self.once, self.twice)


def merged_pairs(parts: DataFrame, bits_log2: int = BITS_LOG2) -> SeenTwice:
    """The twice-seen filter of all tasks, from the rows (block, once, twice) of their pairs."""
    size = 1 << max(bits_log2 - 3, 0)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for block, x, y in zip(*(batch[c].to_pylist() for c in ("block", "once", "twice"))):
                more_once, more_twice = (np.frombuffer(zlib.decompress(z), np.uint8) for z in (x, y))
                if block not in kept:
                    kept[block] = (more_once.copy(), more_twice.copy())
                    continue
                once, twice = kept[block]
                twice |= more_twice | (once & more_once)
                once |= more_once
        for block, (_, twice) in kept.items():
            if twice.any():
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([zlib.compress(twice, 1)], pa.binary())], ["block", "twice"])

    spread = parts.repartition(max(1, min(size // _BLOCK, 64)), "block")
    out = np.zeros(size, np.uint8)
    step = min(_BLOCK, size)
    for row in spread.mapInArrow(merge, "block int, twice binary").collect():
        out[row.block * step : (row.block + 1) * step] = np.frombuffer(zlib.decompress(row.twice), np.uint8)
    return SeenTwice(out.tobytes(), bits_log2)


def seen_twice(df: DataFrame, hashes_of: Callable[[pa.RecordBatch], np.ndarray], bits_log2: int = BITS_LOG2) -> SeenTwice:
    """The twice-seen filter of all hashes that `hashes_of` gives for the batches of `df`."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(bits_log2)
        for batch in batches:
            pair.add(hashes_of(batch))
        yield from pair.blocks()
        del pair
        release()

    return merged_pairs(df.mapInArrow(fill, "block int, once binary, twice binary"), bits_log2)
