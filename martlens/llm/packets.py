"""Finding equal 64-bit values across all tasks, in packed arrays.

A map task gathers (owner, position, values) groups, where a group is a short
run of values at consecutive positions of one owner (a document).  Groups are
dealt to buckets by a key that equal groups share, and sent as one binary
packet per bucket.  A bucket counts its values and answers each owner with the
positions whose value occurs at least twice.  Owners travel once per packet.

Equal groups within a map block are known to repeat: one of them is sent,
marked, and the others go to a bucket drawn from their owner with no values, to
be answered without counting.  So a value that a third of all owners hold
reaches its bucket once per map block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.llm.spans import U64, mix, runs, spread, tidy

_TYPES = [np.dtype(t) for t in ("<u1", "<u2", "<u4", "<u8", "<i8")]
PACKET = pa.schema([("bucket", pa.int32()), ("packet", pa.binary())])
PACKET_DDL = "bucket int, packet binary"
ANSWER = pa.schema([("owner", pa.int64()), ("found", pa.binary())])
ANSWER_DDL = "owner long, found binary"
BLOCK_VALUES = 1_500_000    # values gathered before packets are sent


def join_arrays(*arrays: np.ndarray) -> bytes:
    head = np.array([[_TYPES.index(a.dtype), len(a)] for a in arrays], "<u4")
    return b"".join([head.tobytes(), *(a.tobytes() for a in arrays)])


def split_arrays(raw: bytes, count: int) -> list[np.ndarray]:
    head = np.frombuffer(raw, "<u4", 2 * count).reshape(count, 2).tolist()
    at, out = 8 * count, []
    for kind, n in head:
        out.append(np.frombuffer(raw, _TYPES[kind], n, at))
        at += n * _TYPES[kind].itemsize
    return out


def narrow(x: np.ndarray) -> np.ndarray:
    """The smallest unsigned type that holds all values."""
    top = int(x.max(initial=0))
    return x.astype(_TYPES[0] if top < 1 << 8 else _TYPES[1] if top < 1 << 16 else _TYPES[2] if top < 1 << 32 else _TYPES[3])


def _bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((mix(key, 11) >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int32)


class Sender:
    """Gathers groups of one map task and yields packets."""

    def __init__(self, buckets: int, value_bits: int = 64) -> None:
        self.buckets, self.value_bits = buckets, value_bits
        self._reset()

    def _reset(self) -> None:
        self.held: list[tuple[np.ndarray, ...]] = []
        self.count = 0

    def add(self, owner: np.ndarray, pos: np.ndarray, length: np.ndarray, key: np.ndarray,
            values: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Groups (owner, first position, length, key) and their values, one
        group's after another's; yields packets when enough are held."""
        self.held.append((owner, pos, length, key, values))
        self.count += len(values)
        if self.count >= BLOCK_VALUES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.count:
            return
        owner, pos, length, key, values = (np.concatenate(x) for x in zip(*self.held, strict=True))
        self._reset()
        at = np.cumsum(length) - length
        total = np.append(np.zeros(1, U64), np.cumsum(mix(values + spread(np.zeros(len(length), np.int64), length).astype(U64))))
        content = mix(total[at + length] - total[at], 5) + length.astype(U64)
        order = np.argsort(content, kind="stable")
        start, size = runs(content[order])
        many = np.zeros(len(order), bool)
        many[order[start[size > 1]]] = True             # the first of equal groups speaks for all
        known = np.ones(len(order), bool)
        known[order[start]] = False
        bucket = _bucket_of(np.where(known, owner.astype(U64), key), self.buckets)
        order = np.lexsort((pos, owner, bucket))
        edges = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        names, packets = [], []
        for b in np.flatnonzero(np.diff(edges)):
            g = order[edges[b]:edges[b + 1]]
            ids, which = np.unique(owner[g], return_inverse=True)
            k = known[g]
            v = values[spread(at[g[~k]], length[g[~k]])]
            steps = np.diff(ids, prepend=ids[:1])
            own = [ids[:1].astype("<i8"), narrow(steps)] if int(steps.max(initial=0)) >= 0 else [ids.astype("<i8"), narrow(steps[:0])]
            if self.value_bits == 48:
                parts = [(v >> U64(32)).astype("<u2"), v.astype("<u4")]
            else:
                parts = [v.astype("<u8"), np.zeros(0, "<u1")]
            names.append(int(b))
            packets.append(join_arrays(*own, narrow(which), narrow(pos[g]), narrow(length[g]),
                                       (k * 2 + many[g]).astype("<u1"), *parts))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(packets, pa.binary())], schema=PACKET)


def _open(raw: bytes) -> tuple[np.ndarray, ...]:
    base, steps, which, pos, length, mark, high, low = split_arrays(raw, 8)
    ids = base if len(base) != 1 or not len(steps) else base[0] + np.cumsum(steps.astype(np.int64))
    values = (high.astype(U64) << U64(32)) | low.astype(U64) if high.dtype == _TYPES[1] else high.astype(U64)
    return ids[which.astype(np.int64)], pos.astype(np.int64), length.astype(np.int64), mark, values


def _answer(packets: list[bytes]) -> Iterator[pa.RecordBatch]:
    opened = [_open(p) for p in packets]
    owner, pos, length, mark, values = (np.concatenate(x) for x in zip(*opened, strict=True))
    known = mark >= 2
    sent = np.flatnonzero(~known)
    order = np.argsort(values, kind="stable")
    start, size = runs(values[order])
    twice = np.zeros(len(values), bool)
    twice[order] = np.repeat((size > 1) | _any(np.repeat((mark[sent] & 1).astype(bool), length[sent])[order], start), size)
    # positions found: all of the known groups, those counted twice of the others
    where_sent = np.repeat(pos[sent], length[sent]) + spread(np.zeros(len(sent), np.int64), length[sent])
    who = np.concatenate([np.repeat(owner[sent], length[sent])[twice], np.repeat(owner[known], length[known])])
    where = np.concatenate([where_sent[twice], spread(pos[known], length[known])])
    order = np.lexsort((where, who))
    who, where = who[order], where[order]
    start, size = runs(who)
    for lo in range(0, len(start), 20000):
        part = slice(lo, lo + 20000)
        found = [_ranges(where[a:a + n]) for a, n in zip(start[part].tolist(), size[part].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(who[start[part]]), pa.array(found, pa.binary())], schema=ANSWER)


def _any(flags: np.ndarray, start: np.ndarray) -> np.ndarray:
    return np.logical_or.reduceat(flags, start) if len(start) else np.zeros(0, bool)


def _ranges(where: np.ndarray) -> bytes:
    """Ascending positions as (first, count) pairs of their stretches."""
    cut = np.flatnonzero(np.diff(where) != 1) + 1
    first = np.append(0, cut)
    return np.stack([where[first], np.diff(np.append(first, len(where)))], axis=1).astype("<u4").tobytes()


def answers(packets: DataFrame, buckets: int) -> DataFrame:
    """Per owner, the list of its found ranges (see ``found_ranges``)."""
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            for b, p in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if b != bucket and held:
                    yield from _answer(held)
                    held = []
                bucket = b
                held.append(p.as_py())
        if held:
            yield from _answer(held)

    dealt = packets.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, ANSWER_DDL).groupBy("owner").agg(F.collect_list("found").alias("found"))


def found_ranges(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, count) of all ranges of an array<binary> column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows, data = [], []
    for i, packets in enumerate(column.to_pylist()):
        for p in packets or ():
            rows.append((i, len(p) // 8))
            data.append(p)
    if not rows:
        return (np.zeros(0, np.int64),) * 3
    pairs = np.frombuffer(b"".join(data), "<u4").reshape(-1, 2).astype(np.int64)
    row, n = np.array(rows).T
    return np.repeat(row, n), pairs[:, 0], pairs[:, 1]
