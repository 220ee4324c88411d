"""Exact n-gram Jaccard join by parity sketches.

A document is the set of its distinct WIDTH-word shingles.  A parity sketch
XORs every shingle into a bit array, so equal shingles of two sets cancel and
the Hamming distance of two sketches never exceeds the sets' symmetric
difference.  Linked sets of sizes a and b differ in at most d = (a + b) / 7
shingles (for a similarity of 3/4).

1. Sets are put into bands by size.  For a band the sketch is cut into more
   slices than any link in the band has differences, so two linked sets agree
   in several slices (pigeonhole).  A slice travels as the XOR of the hashes of
   its shingles.  A set sends as many leading slices as its size calls for, in
   its own band and in the next one if it can have larger partners there.
2. Tasks gather equal slices.  Slices that few sets share give all their pairs;
   of the others every set is paired with one centre.  A set whose every link
   must show in a rarer slice too needs no more than that; the sets for which
   this is not so ("heavy": too few of their slices are rare) are searched
   further across the components found so far, see _Heavy.
3. Pairs pass the Hamming test on short sketches, then the exact test on the
   shingle hashes.  Links within one component are not searched further.

Sets that are equal travel as one, whatever the number of their documents.

Edge cases: null and empty texts, and texts without words, have the empty set
and are linked with nothing; shorter texts than WIDTH words are one shingle;
repeated rows are documents with equal sets; a row goes by its id and text, so
the texts of one id are documents of their own; rows with a null id take part,
keep a null id, and have the smallest id of their class (null where it has
none); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.llm.components import components
from martlens.llm.packets import _bucket_of, join_arrays, narrow, split_arrays
from martlens.llm.spans import LOWER, U64, blocks, hash_spans, mix, runs, spread, tidy, window_hashes, word_spans
from martlens.llm.store import Workspace, partitions

WIDTH = 5
SHARE = (75, 100)           # linked when 100 * intersection >= 75 * union
BAND = 1.75                 # ratio of the sizes at the ends of a band
SLACK = 1.15                # slices beyond the differences a link may have
FEW = 8                     # sets that share a rare slice
BLOCK_SLICES = 1_500_000    # slices a map task gathers before it sends
PART_SLICES = 1 << 18       # slices of a bucket that are grouped at once
PIECE_ROWS = 20_000         # rows that a task hands over at once
MINI_WORDS = 16             # longs of the short sketch that joins compare
CELLS = 32                  # cells for each wanted id, see marked()
MOST_CELLS = 1 << 27        # bits that marked() sends to every executor
STAR, RARE, COMMON = 0, 1, 2


def _differences(a, b):
    """Most shingles in which linked sets of sizes a and b differ."""
    num, den = SHARE
    return (a + b) * (den - num) // (den + num)


def _bands() -> np.ndarray:
    """First sizes of the bands."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, math.ceil(out[-1] * BAND)))
    return np.array(out)


BANDS = _bands()
_TOP = BANDS[1:] - 1
_SLICES = (np.ceil((_differences(_TOP, _TOP) + 1) * SLACK) + 2).astype(np.int64)


def _largest_partner(size: np.ndarray, band: np.ndarray) -> np.ndarray:
    num, den = SHARE
    return np.minimum(_TOP[band], size * den // num)


def _sent(size: np.ndarray, band: np.ndarray) -> np.ndarray:
    """Leading slices that a set of this size sends in a band."""
    most = _differences(size, _largest_partner(size, band))
    filled = 1 - np.exp(-size / _SLICES[band])
    return np.minimum(_SLICES[band], np.ceil((most + 1) * SLACK / filled).astype(np.int64) + 2)


def _sure(size: np.ndarray, band: np.ndarray) -> np.ndarray:
    """Slices, empty ones included, in which any link of the set agrees.  The
    count is least for the largest or the smallest partner."""
    num, den = SHARE
    low = np.maximum(-(-size * num // den), -(-BANDS[band] * num // den))
    return np.minimum(_sent(size, band) - _differences(size, _largest_partner(size, band)),
                      _sent(low, band) - _differences(size, low))


class ShingleSets:
    """The shingle sets of a block of texts: sorted hashes, one set after
    another, with offsets; and an id of the set (0 for the empty set)."""

    def __init__(self, raw: np.ndarray, off: np.ndarray) -> None:
        raw = LOWER[raw]
        starts, ends, first = word_spans(raw, off)
        words = hash_spans(raw, starts, ends)
        n_words = np.diff(first)
        grams = window_hashes(words, WIDTH)
        sets = []
        for a, n in zip(first[:-1].tolist(), n_words.tolist(), strict=True):
            if n >= WIDTH:
                sets.append(np.unique(grams[a:a + n - WIDTH + 1]))
            elif n:
                whole = mix(words[a:a + 1], 100 + n)
                for j in range(1, n):
                    whole = mix(whole ^ words[a + j:a + j + 1], j)
                sets.append(whole)
            else:
                sets.append(words[:0])
        self.size = np.array([len(s) for s in sets], np.int64)
        self.hash = np.concatenate([*sets, words[:0]])
        self.first = np.append(0, np.cumsum(self.size))
        total = np.append(np.zeros(1, U64), np.cumsum(mix(self.hash, 21)))
        ids = mix(total[self.first[1:]] - total[self.first[:-1]], 22) + self.size.astype(U64)
        self.id = np.where(self.size > 0, ids, U64(0)).view(np.int64)

    def of(self, i: int) -> np.ndarray:
        return self.hash[self.first[i]:self.first[i + 1]]


def sketch(hashes: np.ndarray) -> bytes:
    """Parity sketch of at least two bits for each shingle."""
    bits = max(64, 1 << (2 * len(hashes) - 1).bit_length())
    return np.packbits((np.bincount((mix(hashes, 31) & U64(bits - 1)).astype(np.int64), minlength=bits) & 1)
                       .astype(np.uint8)).tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    """Hamming distance; the longer sketch is folded to the shorter's length,
    which keeps it a parity sketch."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    n = min(len(x), len(y))
    x = np.bitwise_xor.reduce(x.reshape(-1, n), axis=0)
    y = np.bitwise_xor.reduce(y.reshape(-1, n), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def mini_sketch(hashes: np.ndarray) -> np.ndarray:
    """Parity sketch of MINI_WORDS longs, whatever the size of the set."""
    bits = np.bincount((mix(hashes, 32) & U64(64 * MINI_WORDS - 1)).astype(np.int64), minlength=64 * MINI_WORDS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


DOCS_DDL = "doc_id long, n_shingles long, set_id long, sketch binary, mini array<long>"


def set_table(docs: DataFrame) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.int64()),
                        ("sketch", pa.binary()), ("mini", pa.list_(pa.int64()))])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, raw, off in blocks(batch):
                s = ShingleSets(raw, off)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).cast(pa.int64()), pa.array(s.size), pa.array(s.id),
                     pa.array([sketch(s.of(i)) if s.size[i] else None for i in range(rows.num_rows)], pa.binary()),
                     pa.array([mini_sketch(s.of(i)) if s.size[i] else None for i in range(rows.num_rows)],
                              pa.list_(pa.int64()))],
                    schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, DOCS_DDL)


PACKET = pa.schema([("bucket", pa.int32()), ("packet", pa.binary())])
FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("band", pa.int32()), ("need", pa.int32()), ("kind", pa.int32())])
FOUND_DDL = "a long, b long, band int, need int, kind int"


def _slices(s: ShingleSets) -> tuple[np.ndarray, ...]:
    """Slices of a block of sets: (key, entry), and per entry set id, band and
    the number of agreeing non-empty slices that any of its links has."""
    real = np.flatnonzero(s.size)
    own = np.searchsorted(BANDS, s.size[real], "right") - 1
    who, band, step = [], [], 0
    num, den = SHARE
    while len(real):
        in_band = own + step
        take = s.size[real] * den >= BANDS[in_band] * num if step else np.ones(len(real), bool)
        real, own = real[take], own[take]
        who.append(real)
        band.append(own + step)
        step += 1
    who, band = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (who, band))
    size = s.size[who]
    sent = _sent(size, band)
    at = spread(s.first[who], size)
    entry = np.repeat(np.arange(len(who)), size)
    h = s.hash[at]
    part = ((h >> U64(32)) * _SLICES[band].astype(U64)[entry] >> U64(32)).astype(np.int64)
    keep = part < sent[entry]
    h, entry, part = h[keep], entry[keep], part[keep]
    new = np.ones(len(h), bool)
    new[1:] = (np.diff(entry) != 0) | (np.diff(part) != 0)
    head = np.flatnonzero(new)
    value = np.bitwise_xor.reduceat(mix(h, 41), head) if len(head) else h[:0]
    e, p = entry[head], part[head]
    key = mix(value ^ mix((p + (band[e] << 40)).astype(U64), 42), 43)
    need = _sure(size, band) - (sent - np.bincount(e, minlength=len(who)))
    # where a link may agree in empty slices only, these are sent too
    extra_key, extra_entry = [key[:0]], [e[:0]]
    for i in np.flatnonzero(need <= 0).tolist():
        empty = np.setdiff1d(np.arange(sent[i]), p[e == i])
        extra_key.append(mix(mix((empty + (band[i] << 40)).astype(U64), 44), 45))
        extra_entry.append(np.full(len(empty), i))
    return (np.concatenate([key, *extra_key]), np.concatenate([e, *extra_entry]), s.id[who], band, np.maximum(need, 0))


def _groups(key: np.ndarray, entry: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the slices by (key, set), and starts and sizes of the keys."""
    order = np.lexsort((ids[entry], key))
    return (order, *runs(key[order]))


def _common(order, start, size, which, entry, ids, band, need, name) -> tuple[np.ndarray, ...]:
    """Rows (a, b, band, need, kind) of the chosen keys: links to the centre
    (the smallest set) and memberships.  ``name`` gives the names of slices."""
    at = order[spread(start[which], size[which])]
    centre = np.repeat(ids[entry[order[start[which]]]], size[which])
    member = ids[entry[at]]
    far = member != centre
    zero = np.zeros(int(far.sum()), np.int64)
    return (np.concatenate([centre[far], name(at).view(np.int64)]), np.concatenate([member[far], member]),
            np.concatenate([zero, band[entry[at]]]), np.concatenate([zero, need[entry[at]]]),
            np.concatenate([zero + STAR, np.full(len(at), COMMON)]))


def _found(rows: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(rows[0]), PIECE_ROWS):
        a, b, band, need, kind = (x[lo:lo + PIECE_ROWS] for x in rows)
        yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64)),
                                          pa.array(band.astype(np.int32)),
                                          pa.array(np.minimum(need.astype(np.int64), 1 << 30).astype(np.int32)),
                                          pa.array(kind.astype(np.int32))], schema=FOUND)


def _distinct(a: np.ndarray, b: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, ...]:
    """Different rows of three columns."""
    order = np.lexsort((kind, b, a))
    a, b, kind = a[order], b[order], kind[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (kind[1:] != kind[:-1])
    return a[new], b[new], kind[new]


_SEEN = U64((1 << 48) - 1)      # bits of a key that travel beside its bucket


def _name(key: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Name of a slice, the same wherever it is settled."""
    return (key & _SEEN) | (bucket.astype(U64) << U64(48))


def slice_packets(docs: DataFrame, buckets: int) -> DataFrame:
    """Packets of slices by bucket.  Equal sets of a map block are sent once,
    and a slice that more than FEW of its sets share is settled on the spot:
    one of them is sent, marked, for all."""
    def flush(held) -> Iterator[pa.RecordBatch]:
        shift = np.cumsum([0] + [len(h[2]) for h in held[:-1]])
        key = np.concatenate([h[0] for h in held])
        entry = np.concatenate([h[1] + d for h, d in zip(held, shift, strict=True)])
        ids, band, need = (np.concatenate([h[k] for h in held]) for k in (2, 3, 4))
        once = np.zeros(len(ids), bool)
        once[np.unique(np.stack([ids, band], axis=1), axis=0, return_index=True)[1]] = True
        held.clear()
        if not once.all():
            key, entry = key[once[entry]], entry[once[entry]]
        order, start, size = _groups(key, entry, ids)
        hot = size > FEW
        sent = order[np.concatenate([spread(start[~hot], size[~hot]), start[hot]])]
        mark = np.append(np.zeros(int(size[~hot].sum()), bool), np.ones(int(hot.sum()), bool))
        bucket = _bucket_of(key[sent], buckets)
        by = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[by], np.arange(buckets + 1))
        done = _common(order, start, size, hot, entry, ids, band, need,
                       lambda at: _name(key[at], _bucket_of(key[at], buckets)))
        share = np.array_split(np.arange(len(done[0])), buckets)     # settled rows ride along, evenly
        names, packets = [], []
        for b in range(buckets):
            g = by[edges[b]:edges[b + 1]]
            if not len(g) and not len(share[b]):
                continue
            rows, which = np.unique(entry[sent[g]], return_inverse=True)
            k = key[sent[g]]
            lo, hi = share[b][:1].sum(), share[b][:1].sum() + len(share[b])
            names.append(b)
            packets.append(join_arrays(
                ids[rows].astype("<i8"), band[rows].astype("<u1"), narrow(need[rows]), narrow(which),
                (k >> U64(32)).astype("<u2"), k.astype("<u4"), mark[g].astype("<u1"),
                *(x[lo:hi].astype("<i8") for x in done[:2]), done[2][lo:hi].astype("<u1"), narrow(done[3][lo:hi]),
                done[4][lo:hi].astype("<u1")))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(packets, pa.binary())], schema=PACKET)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for _, raw, off in blocks(batch):
                held.append(_slices(ShingleSets(raw, off)))
                count += len(held[-1][0])
                if count >= BLOCK_SLICES:
                    yield from flush(held)
                    held, count = [], 0
        if count:
            yield from flush(held)

    return docs.select("doc_id", "text").mapInArrow(run, "bucket int, packet binary")


def candidate_rows(packets: DataFrame, buckets: int) -> DataFrame:
    """Rows of kind STAR and RARE (pairs of sets) and COMMON (slice, set)."""
    def settle(held: list[bytes], bucket: int) -> Iterator[pa.RecordBatch]:
        parts = [split_arrays(p, 12) for p in held]
        for p in parts:
            yield from _found(tuple(p[7:]))
        shift = np.cumsum([0] + [len(p[0]) for p in parts[:-1]])
        ids = np.concatenate([p[0] for p in parts])
        band, need = (np.concatenate([p[k] for p in parts]).astype(np.int64) for k in (1, 2))
        # equal slices are in one turn: it goes by the leading bits of the key
        turns = -(-sum(len(p[4]) for p in parts) // PART_SLICES)
        pairs = [(np.zeros(0, np.int64),) * 3]
        for turn in range(turns):
            own = [np.flatnonzero(p[4].astype(np.uint32) * np.uint32(turns) >> np.uint32(16) == turn) for p in parts]
            entry = np.concatenate([p[3][g].astype(np.int64) + d for p, g, d in zip(parts, own, shift, strict=True)])
            key = np.concatenate([(p[4][g].astype(U64) << U64(32)) | p[5][g] for p, g in zip(parts, own, strict=True)])
            mark = np.concatenate([p[6][g] for p, g in zip(parts, own, strict=True)]).astype(bool)
            common, few = grouped(ids, band, need, entry, key, mark, bucket)
            yield from _found(common)
            pairs.append(few)
        a, b, kind = _distinct(*(np.concatenate(x) for x in zip(*pairs, strict=True)))
        zero = np.zeros(len(a), np.int64)
        yield from _found((a, b, zero, zero, kind))

    def grouped(ids, band, need, entry, key, mark, bucket) -> tuple[tuple[np.ndarray, ...], ...]:
        """Rows of the slices that many sets share, and pairs (a, b, kind) of the others."""
        # a set that several blocks sent counts once under a key
        order = np.lexsort((ids[entry], key))
        k, i = key[order], ids[entry[order]]
        first = np.ones(len(order), bool)
        first[1:] = (k[1:] != k[:-1]) | (i[1:] != i[:-1])
        flag = np.logical_or.reduceat(mark[order], np.flatnonzero(first)) if len(order) else mark
        order = order[first]
        start, size = runs(key[order])
        hot = (size > FEW) | (np.logical_or.reduceat(flag, start) if len(start) else flag)
        common = _common(order, start, size, hot, entry, ids, band, need,
                         lambda at: _name(key[at], np.full(len(at), bucket)))
        pairs = [(np.zeros(0, np.int64),) * 3]
        for n in range(2, FEW + 1):
            group = ids[entry[order[start[(size == n) & ~hot][:, None] + np.arange(n)]]]
            for x in range(n):
                for y in range(x + 1, n):
                    pairs.append((group[:, x], group[:, y], np.full(len(group), RARE if x else STAR)))
        return common, _distinct(*(np.concatenate(x) for x in zip(*pairs, strict=True)))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            for b, p in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if b != bucket and held:
                    yield from settle(held, bucket)
                    held = []
                bucket = b
                held.append(p.as_py())
        if held:
            yield from settle(held, bucket)

    return (packets.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket")
            .mapInArrow(run, FOUND_DDL))


def marked(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is in ``wanted``, and few others (one
    in CELLS, while MOST_CELLS allow).  Ids are hashed to cells, and a bit for
    each cell goes to the executors, so that texts are sifted where they are
    read and a join that follows does not shuffle the rest of them."""
    cells = min(MOST_CELLS, max(1 << 15, 1 << (CELLS * wanted.count()).bit_length()))
    cell = F.pmod(F.xxhash64("doc_id"), F.lit(cells)) + 1
    marks = wanted.select(cell.alias("cell")).groupBy(F.bitmap_bucket_number("cell").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("marks"))
    place = F.bitmap_bit_position(cell)
    byte = F.conv(F.hex(F.substring("marks", (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    return docs.join(F.broadcast(marks), (F.bitmap_bucket_number(cell) == F.col("bucket"))
                     & (F.getbit(byte, (place % 8).cast("int")) == 1), "left_semi")


class _Verifier:
    """Turns candidate pairs of sets into links between documents, each set
    standing for its smallest document."""

    def __init__(self, docs: DataFrame, sets: DataFrame, ws: Workspace) -> None:
        self.docs, self.sets, self.ws, self.turn = docs, sets, ws, 0

    def links(self, pairs: DataFrame) -> DataFrame:
        self.turn += 1
        near = self.ws.save(self._near(pairs.select("a", "b").distinct()), f"near-{self.turn}")
        if near.isEmpty():
            return near.select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b"))
        wanted = self.ws.save(near.select(F.col("doc_a").alias("doc_id")).union(
            near.select(F.col("doc_b").alias("doc_id"))).distinct(), f"wanted-{self.turn}")
        shingles = self.ws.save(self._shingles(wanted), f"shingles-{self.turn}", compression="none")
        pairs = (near.join(shingles.select(F.col("doc_id").alias("doc_b"), F.col("hashes").alias("y")), "doc_b")
                 .join(shingles.select(F.col("doc_id").alias("doc_a"), F.col("hashes").alias("x")), "doc_a")
                 .select("doc_a", "doc_b", "x", "y"))
        links = self.ws.save(self._exact(pairs), f"links-{self.turn}")
        for name in ("near", "wanted", "shingles"):
            self.ws.drop(f"{name}-{self.turn}")
        return links

    def _near(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose sizes and sketches allow a link."""
        num, den = SHARE

        @tidy
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                n, m = b.column(2).to_numpy(), b.column(3).to_numpy()
                x, y = b.column(4), b.column(5)
                keep = [i for i, d in enumerate(_differences(n, m).tolist())
                        if sketch_distance(x[i].as_py(), y[i].as_py()) <= d]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["doc_a", "doc_b"]).take(pa.array(keep, pa.int64()))

        def side(k: str) -> DataFrame:
            return self.sets.select(F.col("set_id").alias(k), F.col("doc_id").alias(f"doc_{k}"),
                                    F.col("n_shingles").alias(f"n_{k}"), F.col("sketch").alias(f"sketch_{k}"))

        both = pairs.join(side("b"), "b").join(side("a"), "a").filter(
            (F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num))
        return both.select("doc_a", "doc_b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(run, "doc_a long, doc_b long")

    def _texts(self, wanted: DataFrame) -> DataFrame:
        # rows of one id have one text here (see near_duplicates)
        return marked(self.docs, wanted).join(wanted, "doc_id", "left_semi").select("doc_id", "text")

    def _shingles(self, wanted: DataFrame) -> DataFrame:
        @tidy
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows, raw, off in blocks(batch):
                    s = ShingleSets(raw, off)
                    yield pa.RecordBatch.from_arrays(
                        [rows.column(0).cast(pa.int64()), pa.array([s.of(i).tobytes() for i in range(rows.num_rows)], pa.binary())],
                        names=["doc_id", "hashes"])

        return self._texts(wanted).mapInArrow(run, "doc_id long, hashes binary")

    def exploded(self, wanted: DataFrame) -> DataFrame:
        """(id, h): the shingle hashes of some documents."""
        @tidy
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows, raw, off in blocks(batch):
                    s = ShingleSets(raw, off)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(rows.column(0).to_numpy(), s.size)), pa.array(s.hash.view(np.int64))], names=["id", "h"])

        return self._texts(wanted).mapInArrow(run, "id long, h long")

    def _exact(self, pairs: DataFrame) -> DataFrame:
        num, den = SHARE

        @tidy
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                keep = []
                for i in range(b.num_rows):
                    x, y = (np.frombuffer(b.column(k)[i].as_buffer(), U64) for k in (2, 3))
                    both = len(x) + len(y) - len(np.union1d(x, y))
                    if both * den >= (len(x) + len(y) - both) * num:
                        keep.append(i)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).take(pa.array(keep, pa.int64()))

        return pairs.mapInArrow(run, "a long, b long")


class _Heavy:
    """What is left to search among the heavy sets.

    Of a heavy set, count the shingles that no heavy set of another component
    has (its exclusive ones).  A link to another component cannot contain them:
    with e exclusive shingles a set of size n has such a link only if
    n - e >= 3/4 n, and two sets only if the smaller of their n - e reaches
    3/7 (n + m).  Sets that fail leave, which makes more shingles exclusive.
    """

    PEELS = 2

    def __init__(self, verifier: _Verifier, common: DataFrame) -> None:
        self.verifier, self.ws = verifier, verifier.ws
        heavy = common.groupBy("b", "band").agg(F.count(F.lit(1)).alias("n"), F.max("need").alias("need")) \
            .filter("n >= need").select("b", "band")
        self.members = self.ws.save(
            common.join(heavy, ["b", "band"]).select(F.col("a").alias("slice"), F.col("b").alias("set_id")).distinct()
            .join(verifier.sets.select("set_id", F.col("doc_id").alias("id"), F.col("n_shingles").alias("size")), "set_id"),
            "members")
        self.shingles: DataFrame | None = None
        self.turn = 0

    def _split(self, parts: DataFrame, also: list[str]) -> DataFrame:
        """Members, with their component, of slices that two components share."""
        placed = self.members.join(parts.select("id", "component", *also), "id", "left" if not also else "inner") \
            .withColumn("part", F.coalesce("component", "id")).drop("component")
        split = placed.groupBy("slice").agg(F.min("part").alias("lo"), F.max("part").alias("hi")) \
            .filter("lo <> hi").select("slice")
        return placed.join(split, "slice", "left_semi")

    def exclusive(self, parts: DataFrame) -> DataFrame:
        """(id, component, exclusive) of the sets that may have a link to
        another component."""
        num, den = SHARE
        self.turn += 1
        live = self.ws.save(self._split(parts, []).select("id", "part", "size").distinct(), f"live-{self.turn}")
        if live.isEmpty():
            return live.select("id", F.col("part").alias("component"), F.col("size").alias("exclusive"))
        if self.shingles is None:
            self.shingles = self.ws.save(self.verifier.exploded(live.select(F.col("id").alias("doc_id"))),
                                         "heavy-shingles", compression="none")
        for peel in range(self.PEELS):
            at = self.shingles.join(live.select("id", "part"), "id")
            shared = at.groupBy("h").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo <> hi").select("h")
            count = at.join(shared, "h", "left_semi").groupBy("id").agg(F.count(F.lit(1)).alias("shared"))
            live = self.ws.save(
                live.select("id", "part", "size").join(count, "id").filter(F.col("shared") * den >= F.col("size") * num)
                .withColumn("exclusive", F.col("size") - F.col("shared")), f"live-{self.turn}-{peel}")
        return live.select("id", F.col("part").alias("component"), "exclusive")

    def stars(self, live: DataFrame) -> DataFrame:
        """Pairs of sets: per slice, everyone with the set that is least its own."""
        members = self._split(live, ["exclusive"])
        centre = members.groupBy("slice").agg(F.min(F.struct("exclusive", "set_id", "part")).alias("c"))
        return members.join(centre, "slice").filter("part <> c.part").select(
            F.col("c.set_id").alias("a"), F.col("set_id").alias("b")).distinct()

    def pairs(self, live: DataFrame) -> DataFrame:
        """All pairs of sets with a common slice that may still be linked, by
        their exclusive shingles and by their short sketches."""
        num, den = SHARE
        left = (self._split(live, ["exclusive"]).join(self.verifier.sets.select("set_id", "mini"), "set_id")
                .select("slice", "set_id", "part", "size", (F.col("size") - F.col("exclusive")).alias("most"), "mini"))
        right = left.select("slice", *[F.col(c).alias(f"{c}_") for c in left.columns[1:]])
        may = (F.least("most", "most_") * (den + num) >= (F.col("size") + F.col("size_")) * num)
        apart = sum(F.bit_count(F.get("mini", F.lit(i)).bitwiseXOR(F.get("mini_", F.lit(i)))) for i in range(MINI_WORDS))
        near = apart * (den + num) <= (F.col("size") + F.col("size_")) * (den - num)
        return left.join(right, (left["slice"] == right["slice"]) & (F.col("set_id") < F.col("set_id_"))
                         & (F.col("part") != F.col("part_")) & may & near).select(F.col("set_id").alias("a"), F.col("set_id_").alias("b"))


class _Parts:
    """(id, component) of every document with a link, as links are added."""

    def __init__(self, ws: Workspace, links: DataFrame) -> None:
        self.ws, self.turn = ws, 1
        self.table = ws.save(components(links, ws, "part-1"), "parts-1")

    def add(self, links: DataFrame) -> None:
        """Only the components that ``links`` join are named anew."""
        if links.isEmpty():
            return
        self.turn += 1
        between = links
        for k in ("a", "b"):
            place = self.table.select(F.col("id").alias(k), F.col("component").alias("part"))
            between = between.join(place, k, "left").withColumn(k, F.coalesce("part", k)).drop("part")
        over = self.ws.save(components(between, self.ws, f"part-{self.turn}"), f"over-{self.turn}")
        # a component is named by one of its documents, and a document without a link so far by itself
        placed = self.table.join(over.select(F.col("id").alias("component"), F.col("component").alias("whole")), "component", "left")
        self.table = self.ws.save(placed.select("id", F.coalesce("whole", "component").alias("component")).union(
            over).distinct(), f"parts-{self.turn}")
        self.ws.drop(f"over-{self.turn}")
        self.ws.drop(f"parts-{self.turn - 1}")


def near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``."""
    ws = Workspace(spark, "rows")
    # a row goes by its id and text: texts that share an id, or have none, are told apart
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))
    classes = ws.save(classes_by_key(spark, keyed.select(F.col("key").alias("doc_id"), "text")).groupBy(
        F.col("doc_id").alias("key")).agg(F.min("n_shingles").alias("n_shingles"), F.min("component_id").alias("part")), "classes")
    rows = keyed.select("doc_id", "key").join(classes, "key")
    first = rows.filter("n_shingles > 0").groupBy("part").agg(F.min("doc_id").alias("component_id"))
    return rows.join(first, "part", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def classes_by_key(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The same for a ``doc_id`` that is never null and has one text only; the
    class is named by its smallest one."""
    ws = Workspace(spark, "jaccard")
    buckets = partitions(spark)
    docs = docs.select("doc_id", "text")
    rows = ws.save(set_table(docs), "rows")
    sets = ws.save(rows.filter("n_shingles > 0").groupBy("set_id").agg(
        F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("n_shingles"), F.min("sketch").alias("sketch"),
        F.min("mini").alias("mini")), "sets")
    found = ws.save(candidate_rows(slice_packets(docs, buckets), buckets), "found",
                    partition_by=("kind",))
    verifier = _Verifier(docs, sets, ws)
    links = verifier.links(found.filter(F.col("kind") == STAR))
    parts = _Parts(ws, links)
    place = sets.select("set_id", F.col("doc_id").alias("id")).join(parts.table, "id", "left") \
        .select("set_id", F.coalesce("component", "id").alias("part"))
    rare = (found.filter(F.col("kind") == RARE).select("a", "b").distinct()
            .join(place.select(F.col("set_id").alias("a"), F.col("part").alias("part_a")), "a")
            .join(place.select(F.col("set_id").alias("b"), F.col("part").alias("part_b")), "b")
            .filter("part_a <> part_b").select("a", "b"))
    parts.add(verifier.links(rare))
    heavy = _Heavy(verifier, found.filter(F.col("kind") == COMMON))
    live = heavy.exclusive(parts.table)
    if not live.isEmpty():
        more = verifier.links(heavy.stars(live))
        parts.add(more)
        if not more.isEmpty():
            live = heavy.exclusive(parts.table)
        parts.add(verifier.links(heavy.pairs(live)))
    final = parts.table
    for name in ("found", "members", "heavy-shingles"):     # read for the last time
        ws.drop(name)
    owner = sets.select("set_id", F.col("doc_id").alias("id")).join(final, "id", "left") \
        .select("set_id", F.coalesce("component", "id").alias("component_id"))
    return rows.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("set_id")).alias("set_id")) \
        .join(owner, "set_id", "left").select(
            "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def op1_jaccard_join(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return near_duplicates(spark, docs)
