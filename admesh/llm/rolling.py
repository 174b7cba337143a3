"""Hashes of many byte ranges of a buffer at once."""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every output bit depends on every input bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


# A random value per byte, so that equal sums of raw byte values do not collide.
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def of(base):
        out = np.empty(size, np.uint64)
        out[0] = 1
        known = 1
        while known < size:
            more = min(known, size - known)
            out[known:known + more] = out[:more] * np.uint64(pow(base, known, 1 << 64))
            known += more
        return out
    return of(_BASE), of(_UNBASE)


class RangeHashes:
    """64-bit hashes of ranges of a byte buffer; equal bytes have equal hashes.

    The hash of bytes ``c_0 .. c_n`` is the sum of ``value(c_j) * base**-j``,
    found for any range from one running sum, then mixed with the length.
    """

    def __init__(self, buffer: np.ndarray):
        size = 1 << max(12, int(len(buffer)).bit_length())
        self.up, down = _powers(size)
        self.sums = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum(_BYTES[buffer] * down[:len(buffer)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.sums[ends] - self.sums[starts]) * self.up[starts]
        return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def chunks(batches: Iterator[pa.RecordBatch], size: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts hold about ``size`` bytes, one row at least."""
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64))
        at = 0
        while at < len(ends):
            base = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, base + size, "right")))
            yield batch.slice(at, stop - at)
            at = stop


def joined(texts: list[bytes], gap: bytes = b"\n") -> tuple[np.ndarray, np.ndarray]:
    """One buffer of all texts with ``gap`` after each, and the texts' starts (one more at the end)."""
    lengths = np.array([len(t) + len(gap) for t in texts], np.int64)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(lengths, out=starts[1:])
    return np.frombuffer(gap.join(texts) + gap, np.uint8), starts


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values."""
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
