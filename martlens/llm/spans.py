"""Vectorised work on the UTF-8 bytes of an Arrow text column.

Spark hands whole batches of texts to Python as one byte buffer with offsets.
The helpers below cut that buffer into spans (words), hash every span, and
combine span hashes over sliding windows, with numpy and without a Python
object per word.  Texts are taken in blocks of a MB or so, so memory follows the
block or the longest single text, whichever is larger.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
BLOCK_BYTES = 1 << 20       # bytes of text handled at once
LANES = 1 << 19             # 8-byte lanes of long spans hashed at once
_M = (1 << 64) - 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def tidy(run):
    """Decorate an Arrow function: when its task ends, memory that numpy and
    Arrow hold free goes back to the system.  Workers live on from task to
    task, and what each step of a job once needed would add up."""
    @functools.wraps(run)
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):     # only glibc has it
                ctypes.CDLL(None).malloc_trim(0)

    return tidied


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(n, U64)
    filled, factor = 1, base
    while filled < n:
        take = min(filled, n - filled)
        out[filled:filled + take] = out[:take] * U64(factor)
        factor = factor * factor & _M
        filled += take
    return out


class _Tables:
    """Powers of an odd base and of its inverse; grown on demand."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            self.up, self.down = _powers(self.base, n), _powers(self.inverse, n)
        return self.up, self.down


_WORDS = (_Tables(0xD6E8FEB86659FD93), _Tables(0xA0761D6478BD642F))
#: Mask of the first 0 .. 8 bytes of a little-endian lane.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit values (xor-shift and multiply)."""
    x = x + U64((0x9E3779B97F4A7C15 * (seed + 1)) & _M)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a string column, and n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type)
    off = np.frombuffer(column.buffers()[1], np.int64 if large else np.int32)
    off = off[column.offset:column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def blocks(batch: pa.RecordBatch, text: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row blocks of about BLOCK_BYTES with their text bytes and offsets."""
    raw, off = text_bytes(batch.column(batch.schema.get_field_index(text)))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + BLOCK_BYTES, "right")) - 1)
        yield batch.slice(lo, hi - lo), raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def word_spans(raw: np.ndarray, off: np.ndarray, apart: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` and the index of the
    first word of each text (n + 1 values).  ``apart`` tells for each byte
    whether it stands between words."""
    solid = np.zeros(len(raw) + 1, bool)
    np.logical_not(apart[raw], out=solid[1:])
    first = np.zeros(len(raw) + 1, bool)
    first[off] = True                       # a text always starts anew
    starts = np.flatnonzero(solid[1:] & (~solid[:-1] | first[:-1]))
    after = np.append(solid[1:], False)     # does a word go on at this byte
    ends = np.flatnonzero(solid[1:] & (~after[1:] | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of the bytes of each span; another seed gives an independent one.

    A span is read in 8-byte lanes.  Each lane is scrambled together with its
    number, the scrambled lanes are summed, and the sum is scrambled with the
    length: one rule for every length."""
    size = ends - starts
    # lane at any byte: an unaligned view of the bytes and 8 zeros
    lane_at = np.ndarray((len(raw) + 1,), "<u8", np.concatenate([raw, np.zeros(8, np.uint8)]), strides=(1,))
    total = mix(lane_at[starts] & _FIRST[np.minimum(size, 8)], 31 + seed)
    more = np.maximum(size - 1, 0) >> 3                     # lanes after the first
    long = np.flatnonzero(more)
    until = np.cumsum(more[long])
    for lo in range(0, int(until[-1]) if len(long) else 0, LANES):
        lane = np.arange(lo, min(lo + LANES, int(until[-1])))
        which = np.searchsorted(until, lane, "right")
        number = lane - until[which] + more[long[which]] + 1
        at = starts[long[which]] + 8 * number
        value = lane_at[at] & _FIRST[np.minimum(ends[long[which]] - at, 8)]
        head, _ = runs(which)
        total[long[which[head]]] += np.add.reduceat(mix(value ^ mix(number.astype(U64), 32 + seed), 31 + seed), head)
    return mix(total ^ mix(size.astype(U64), 33 + seed))


def window_hashes(words: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """Hash of every run of ``width`` consecutive values (none if too few)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    if width <= 8:
        base = U64(_WORDS[which].base)
        out = words[width - 1:width - 1 + n].copy()
        for j in range(width - 2, -1, -1):
            out *= base
            out += words[j:j + n]
        return mix(out, which)
    up, down = _WORDS[which].get(len(words))
    total = np.zeros(len(words) + 1, U64)
    np.cumsum(words * up[:len(words)], out=total[1:])
    return mix((total[width:] - total[:n]) * down[:n], which)


def runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values."""
    if not len(sorted_values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1]))
    return starts, np.diff(np.append(starts, len(sorted_values)))


def spread(offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices offsets[i] .. offsets[i] + lengths[i] - 1, one range after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(offsets - (ends - lengths), lengths)
