"""Near-duplicate vectors by iterative quantisation and multi-index tables.

1. Equal vectors travel as one, with the number of their copies.
2. Rotations are learned on a bounded sample (iterative quantisation: turn the
   centred unit vectors so that their signs lose as little as possible, by
   alternating sign codes and an orthogonal Procrustes fit).  Thresholds are
   the sample's medians, which balances every bit.  Several rotations from
   different starts give the tables their bits.  Lengths that the sample hardly
   shows get random rotations, to which the recall below applies as well.
3. A code is cut into tables of BITS bits, and a vector enters every table
   under all keys with one bit left out, so two vectors meet if a table's bits
   differ in at most one place.  The number of tables follows from the
   similarity and the wanted recall, the bits of a table from the number of
   vectors (log2, as usual for multi-index hashing).
4. Vectors that meet are compared by their whole codes, then grouped again with
   the original vectors and compared by cosine in double precision.  A pair
   belongs to one key only, the first it meets under, so it counts once.
   Large groups are dealt as tiles of two chunks each.

Edge cases: vectors that are null, empty, all zero or hold a null or non-finite
component link with nothing; vectors of different lengths are not compared;
repeated rows of an id count as copies; of an id with several vectors each has
its own links and component, which the id itself does not connect; rows with a
null id link nothing and keep a null id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.llm.components import components
from martlens.llm.packets import _bucket_of, join_arrays, split_arrays
from martlens.llm.spans import U64, mix, runs, tidy
from martlens.llm.store import Workspace, partitions

SIMILARITY = 0.9
RECALL = 0.985              # wanted of pairs exactly at SIMILARITY
SAMPLE = 20_000             # vectors the rotations are learned on
LEAST_LENGTH = 16           # shorter vectors get random rotations: learned ones would all be alike,
LEAST_SAMPLE = 10           # and so do lengths with fewer sampled vectors than this many per component
LEAST_BITS = 16
ROUNDS = 25
CHUNK = 1024                # vectors of one side of a tile
SLACK = 3.0                 # standard deviations allowed to the whole code's distance


def learn_rotation(unit: np.ndarray, seed: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Rotation (d, d) and thresholds (d) for sign codes of unit vectors."""
    d = unit.shape[1]
    turn = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))[0]
    if d < LEAST_LENGTH or len(unit) < LEAST_SAMPLE * d:
        return turn, np.zeros(d)
    centred = unit - unit.mean(axis=0)
    for _ in range(rounds):
        codes = np.where(centred @ turn >= 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(centred.T @ codes)
        turn = u @ v
    return turn, np.median(unit @ turn, axis=0)


class Tables:
    """The rotations for each vector length and the layout of the tables."""

    def __init__(self, sample: list[np.ndarray], count: int, similarity: float = SIMILARITY) -> None:
        self.similarity = similarity
        self.bits = max(LEAST_BITS, math.ceil(math.log2(max(2, count))))
        flip = math.acos(similarity) / math.pi
        meet = (1 - flip) ** self.bits + self.bits * flip * (1 - flip) ** (self.bits - 1)
        self.tables = max(1, math.ceil(math.log(1 - RECALL) / math.log(1 - meet)))
        total = self.bits * self.tables
        self.most = total * flip + SLACK * math.sqrt(total * flip * (1 - flip))
        by_length: dict[int, list[np.ndarray]] = {}
        for v in sample:
            by_length.setdefault(len(v), []).append(v)
        self.sample = {d: np.array(v) for d, v in by_length.items()}
        self.rotations: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for d in self.sample:
            self.rotation(d)
        self.sample = {}

    def rotation(self, d: int) -> tuple[np.ndarray, np.ndarray]:
        """As many learned rotations side by side as the tables need bits."""
        if d not in self.rotations:
            unit = self.sample.get(d, np.zeros((0, d)))
            learned = [learn_rotation(unit, seed) for seed in range(-(-self.bits * self.tables // d))]
            self.rotations[d] = tuple(np.concatenate(x, axis=-1) for x in zip(*learned, strict=True))
        return self.rotations[d]

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """(n, tables) codes of BITS bits each."""
        turn, threshold = self.rotation(unit.shape[1])
        # rounded, as a product's last bits depend on how many rows are multiplied at once
        signs = (np.round(unit @ turn - threshold, 9) >= 0)[:, :self.bits * self.tables]
        weights = np.left_shift(np.uint64(1), np.arange(self.bits, dtype=U64))
        return (signs.reshape(len(unit), self.tables, self.bits) * weights).sum(axis=2, dtype=U64)

    def keys(self, codes: np.ndarray, d: int) -> np.ndarray:
        """(n, tables * bits) keys: a table's code with one bit left out."""
        holes = np.left_shift(np.uint64(1), np.arange(self.bits, dtype=U64))
        cells = codes[:, :, None] & ~holes
        where = np.arange(self.tables * self.bits, dtype=U64).reshape(1, self.tables, self.bits) + U64(d << 32)
        return mix(cells ^ mix(where, 51), 52).reshape(len(codes), -1)

    def owned(self, x: np.ndarray, y: np.ndarray, slot: int) -> np.ndarray:
        """Which pairs of code rows meet first in ``slot``, and are near as a whole."""
        apart = np.bitwise_count(x ^ y)
        table, hole = divmod(slot, self.bits)
        meets = apart <= 1
        first = meets[..., table] & ~meets[..., :table].any(axis=-1)
        differ = (x ^ y)[..., table]
        place = np.where(differ == 0, np.uint64(1), differ)
        return first & (place == U64(1 << hole)) & (apart.sum(axis=-1) <= self.most)


def _vectors(ids: pa.Array, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) for each vector length of a batch."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    first = column.offsets.to_numpy()[:-1] - column.offsets[0].as_py()
    ids = ids.to_numpy()
    for d in np.unique(lengths):
        pick = np.flatnonzero(lengths == d)
        yield ids[pick], flat[first[pick][:, None] + np.arange(d)]


def _unit(matrix: np.ndarray) -> np.ndarray:
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)     # no overflow in the squares
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def usable(column: str) -> Column:
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(column).isNotNull() & finite & F.exists(column, lambda x: x != 0), F.lit(False))


def key_packets(vectors: DataFrame, tables: Tables, buckets: int) -> DataFrame:
    schema = pa.schema([("bucket", pa.int32()), ("packet", pa.binary())])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, matrix in _vectors(batch.column(0), batch.column(1)):
                for lo in range(0, len(ids), 4096):
                    part = slice(lo, lo + 4096)
                    codes = tables.codes(_unit(matrix[part]))
                    keys = tables.keys(codes, matrix.shape[1])
                    slot = np.tile(np.arange(keys.shape[1], dtype=np.uint16), len(keys))
                    who = np.repeat(np.arange(len(keys), dtype=np.uint16), keys.shape[1])
                    flat = keys.reshape(-1)
                    bucket = _bucket_of(flat, buckets)
                    order = np.argsort(bucket, kind="stable")
                    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
                    names, packets = [], []
                    for b in np.flatnonzero(np.diff(edges)):
                        g = order[edges[b]:edges[b + 1]]
                        rows, which = np.unique(who[g], return_inverse=True)
                        names.append(int(b))
                        packets.append(join_arrays(ids[part][rows].astype("<i8"), codes[rows].reshape(-1).astype("<u8"),
                                                   which.astype("<u2"), slot[g].astype("<u2"), flat[g].astype("<u8")))
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(packets, pa.binary())], schema=schema)

    return vectors.mapInArrow(run, "bucket int, packet binary")


MEMBER_DDL = "tile long, slot int, id long, side int"


def tile_members(packets: DataFrame, tables: Tables, buckets: int) -> DataFrame:
    """(tile, slot, id, side): the vectors to compare.  Side 2 is both sides."""
    schema = pa.schema([("tile", pa.int64()), ("slot", pa.int32()), ("id", pa.int64()), ("side", pa.int32())])

    def rows(tile, slot, ids, side) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(tile.view(np.int64)), pa.array(slot.astype(np.int32)), pa.array(ids),
                                           pa.array(side.astype(np.int32))], schema=schema)

    def settle(held: list[bytes]) -> Iterator[pa.RecordBatch]:
        parts = [split_arrays(p, 5) for p in held]
        shift = np.cumsum([0] + [len(p[0]) for p in parts[:-1]])
        ids = np.concatenate([p[0] for p in parts])
        codes = np.concatenate([p[1] for p in parts]).reshape(len(ids), -1).astype(U64)
        who = np.concatenate([p[2].astype(np.int64) + d for p, d in zip(parts, shift, strict=True)])
        slot = np.concatenate([p[3] for p in parts]).astype(np.int64)
        key = np.concatenate([p[4] for p in parts]).astype(U64)
        order = np.argsort(key, kind="stable")
        start, size = runs(key[order])
        # small groups: only members of a pair that belongs here and is near as a whole
        for n in np.unique(size[(size > 1) & (size <= 48)]).tolist():
            heads = start[size == n]
            for lo in range(0, len(heads), max(1, 200_000 // (n * n))):
                at = order[heads[lo:lo + max(1, 200_000 // (n * n))][:, None] + np.arange(n)]
                near = np.zeros(at.shape, bool)
                slots = slot[at[:, 0]]
                for s in np.unique(slots).tolist():
                    g = np.flatnonzero(slots == s)
                    c = codes[who[at[g]]]
                    own = tables.owned(c[:, :, None, :], c[:, None, :, :], s)
                    own[:, np.arange(n), np.arange(n)] = False
                    near[g] = own.any(axis=2)
                i, j = np.nonzero(near)
                pick = at[i, j]
                yield rows(key[pick], slot[pick], ids[who[pick]], np.full(len(pick), 2))
        # larger ones: all members, dealt as tiles of two chunks
        for lo, n in zip(start[size > 48].tolist(), size[size > 48].tolist(), strict=True):
            at = order[lo:lo + n]
            at = at[np.argsort(ids[who[at]], kind="stable")]
            chunks = [at[k:k + CHUNK] for k in range(0, n, CHUNK)]
            for x in range(len(chunks)):
                for y in range(x, len(chunks)):
                    tile = mix(key[at[:1]] + U64(x << 32) + U64(y), 61)
                    for side, chunk in ((2, chunks[x]),) if x == y else ((0, chunks[x]), (1, chunks[y])):
                        yield rows(np.repeat(tile, len(chunk)), slot[chunk], ids[who[chunk]], np.full(len(chunk), side))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            for b, p in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if b != bucket and held:
                    yield from settle(held)
                    held = []
                bucket = b
                held.append(p.as_py())
        if held:
            yield from settle(held)

    return (packets.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket")
            .mapInArrow(run, MEMBER_DDL))


def compare_tiles(members: DataFrame, tables: Tables, tasks: int) -> DataFrame:
    """(id, other, links): for each vector of a tile its number of linked
    vectors (weighted by copies), and links enough to connect the tile."""
    schema = pa.schema([("id", pa.int64()), ("other", pa.int64()), ("links", pa.int64())])

    def settle(tile: pa.Table) -> pa.RecordBatch:
        slot = tile.column("slot")[0].as_py()
        ids = tile.column("id").to_numpy()
        copies = tile.column("copies").to_numpy()
        side = tile.column("side").to_numpy()
        _, matrix = next(_vectors(tile.column("id").combine_chunks(), tile.column("embedding").combine_chunks()))
        unit = _unit(matrix)
        codes = tables.codes(unit)
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        count = np.zeros(len(ids), np.int64)
        pairs = []
        for lo in range(0, len(left), 64):
            x = left[lo:lo + 64]
            near = unit[x] @ unit[right].T >= tables.similarity
            i, j = np.nonzero(near & (ids[x][:, None] < ids[right][None, :]))
            a, b = x[i], right[j]
            if side[0] != 2 or (side != 2).any():       # of two chunks, either may hold the smaller id
                i, j = np.nonzero(near & (ids[x][:, None] > ids[right][None, :]))
                a, b = np.append(a, x[i]), np.append(b, right[j])
            own = tables.owned(codes[a], codes[b], slot)
            a, b = a[own], b[own]
            np.add.at(count, a, copies[b])
            np.add.at(count, b, copies[a])
            pairs.append(np.stack([a, b], axis=1))
        tree = _forest(np.concatenate(pairs), len(ids)) if pairs else np.zeros((0, 2), np.int64)
        some = np.flatnonzero(count)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([ids[some], ids[tree[:, 0]]])),
             pa.array(np.concatenate([ids[some], ids[tree[:, 1]]])),
             pa.array(np.concatenate([count[some], np.zeros(len(tree), np.int64)]))], schema=schema)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, name = [], None
        for batch in batches:
            tiles = batch.column(0).to_numpy()
            start, size = runs(tiles)
            for lo, n in zip(start.tolist(), size.tolist(), strict=True):
                if tiles[lo] != name and open_:
                    yield settle(pa.Table.from_batches(open_))
                    open_ = []
                name = tiles[lo]
                open_.append(batch.slice(lo, n))
        if open_:
            yield settle(pa.Table.from_batches(open_))

    return members.repartition(tasks, "tile").sortWithinPartitions("tile").mapInArrow(run, "id long, other long, links long")


def _forest(pairs: np.ndarray, n: int) -> np.ndarray:
    """For each connected part of a small graph, links from its first node."""
    root = np.arange(n)
    while len(pairs):
        low = np.minimum(root[pairs[:, 0]], root[pairs[:, 1]])
        before = root.copy()
        np.minimum.at(root, pairs[:, 0], low)
        np.minimum.at(root, pairs[:, 1], low)
        root = root[root]
        if (root == before).all():
            break
    child = np.flatnonzero(root != np.arange(n))
    return np.stack([child, root[child]], axis=1)


def near_vectors(spark: SparkSession, table: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    ws = Workspace(spark, "itq")
    rows = table.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    good = usable("embedding") & F.col("vec_id").isNotNull()
    # a vector goes by a hash of its own: an id may have several, of different lengths even
    groups = ws.save(rows.filter(good).groupBy("embedding").agg(
        F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies")).withColumn("id", F.xxhash64("embedding")), "groups")
    sample = groups.orderBy(F.xxhash64("id")).limit(SAMPLE).select("embedding").toPandas()["embedding"]
    count = groups.count()
    tables = Tables([_unit(np.array(v, float)[None, :])[0] for v in sample], count, similarity)
    buckets = partitions(spark)
    vectors = groups.select("id", "embedding").repartition(buckets, "id")
    members = tile_members(key_packets(vectors, tables, buckets), tables, buckets)
    compared = ws.save(compare_tiles(members.join(groups, "id").select("tile", "slot", "id", "side", "copies", "embedding"),
                                     tables, buckets), "compared")
    counts = compared.groupBy("id").agg(F.sum("links").alias("links"))
    parts = components(compared.filter("id <> other").select(F.col("id").alias("a"), F.col("other").alias("b")), ws, "parts")
    named = groups.join(parts, "id", "left").withColumn("part", F.coalesce("component", "id")).select(
        "id", "embedding", "vec_id", "copies", "part")
    first = named.groupBy("part").agg(F.min("vec_id").alias("component_id"))
    placed = ws.save(named.join(first, "part").join(counts, "id", "left").select(
        "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "placed")
    linked = rows.filter(good).join(placed, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.filter(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).select("vec_id", "n_links", "component_id",
                                            F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op4_quantised_neighbours(spark: SparkSession, table: DataFrame) -> DataFrame:
    """Links, component and whether it is its first, for every vector."""
    return near_vectors(spark, table)
