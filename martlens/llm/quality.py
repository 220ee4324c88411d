"""Quality scores from random-indexing word vectors and a small network.

1. A word becomes two tokens: its letters and marks as they are, and its shape
   (case, first and last byte, length, whether it repeats the word before).  Tokens are hashed into SLOTS slots.
   Every slot has a fixed sparse ternary index vector; a token's context vector
   is the sum of the index vectors of its neighbours over all documents.  The
   sums are whole numbers, gathered per task and added up per slot, so they do
   not depend on the order of the work.  Their size is fixed by SLOTS x DIMS.
2. A document is pooled to the mean and spread of its tokens' vectors.
3. A two-layer network learns from a bounded sample of labelled documents
   (SAMPLE rows, the smallest by a hash of the id), and one temperature,
   fitted on a fifth of the sample that the network did not see, with a prior
   at 1 that few rows cannot outvote, calibrates its probabilities.

The slots are hashing: SLOTS is a documented parameter of the model, like DIMS.
Words that share a slot share a vector; README gives figures on how many do.

Labels are read only where crc32 of the id as text, modulo 3, is not 1.
Labels, language, source and id are no inputs of a score.

Edge cases: null and empty texts pool to zeros and get a score like any other;
repeated rows are scored each; of a repeated label the smaller counts; rows
with a null id are scored, and are neither held out nor learned from; without
usable labels every score is 0.5, with one class only the smoothed share of
label 1; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.llm.spans import U64, blocks, hash_spans, mix, runs, spread, tidy, word_spans


SHAPE_SLOTS = 2048
SLOTS = 16384               # of which the first SHAPE_SLOTS are shapes
DIMS = 64
SPIKES = 4                  # non-zero places of an index vector
REACH = 2                   # neighbouring words on each side
SAMPLE = 20_000             # labelled documents the network learns from
LIFT = 4 * REACH            # no neighbourhood sums to less than -LIFT or more than LIFT in a place
LIFTED = (1 << 16) // (2 * LIFT + 1)
HIDDEN = 32
EPOCHS = 60
GROUP = 256                 # slots that travel together
PRIOR = 1.0                 # weight of a temperature of 1, against the rows kept apart
STEP = 50_000               # tokens worked on at once
MANY = 64                   # different slots from which on a text is pooled on its own
TEXTS = 512                 # texts whose shapes are counted at once


def index_places(seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of every slot's index vector."""
    rng = np.random.default_rng(seed)
    places = np.argsort(rng.random((SLOTS, DIMS)), axis=1)[:, :SPIKES]
    return places.astype(np.int64), rng.choice([-1, 1], (SLOTS, SPIKES)).astype(np.int64)


def index_vectors() -> np.ndarray:
    """Every slot's index vector: SPIKES places of DIMS hold 1 or -1."""
    places, signs = index_places()
    out = np.zeros((SLOTS, DIMS), np.int8)
    np.put_along_axis(out, places, signs.astype(np.int8), axis=1)
    return out


def _kinds() -> np.ndarray:
    """0 small letter, 1 capital, 2 digit, 3 beyond ASCII, 4 other."""
    out = np.full(256, 4, np.uint8)
    out[97:123], out[65:91], out[48:58], out[128:] = 0, 1, 2, 3
    return out


_KIND = _kinds()


def token_slots(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word slots, shape slots and the first word of each text."""
    starts, ends, first = word_spans(raw, off)
    hashes = hash_spans(raw, starts, ends)
    words = SHAPE_SLOTS + (hashes % U64(SLOTS - SHAPE_SLOTS)).astype(np.int64)
    if not len(starts):
        return words, words, first
    capital = np.append(0, np.cumsum(_KIND[raw] == 1))
    mark = np.append(0, np.cumsum(_KIND[raw] == 4))
    size = ends - starts
    capitals, marks = capital[ends] - capital[starts], mark[ends] - mark[starts]
    shouts = (capitals > 1) & (capitals * 2 > size - marks)
    again = np.append(False, hashes[1:] == hashes[:-1])         # the word before, once more
    again[first[:-1][first[:-1] < len(again)]] = False
    last = raw[ends - 1]
    tail = np.where(_KIND[last] == 4, last, _KIND[last]).astype(U64)
    shape = (tail + (_KIND[raw[starts]].astype(U64) << U64(8)) + (np.minimum(marks, 4).astype(U64) << U64(12))
             + (shouts.astype(U64) << U64(16)) + (np.minimum(np.log2(size).astype(np.int64), 6).astype(U64) << U64(20))
             + (again.astype(U64) << U64(28)))
    return words, (mix(shape, 71) % U64(SHAPE_SLOTS)).astype(np.int64), first


GROUP_ROW = pa.schema([("part", pa.int32()), ("sums", pa.binary())])


def _small(x: np.ndarray) -> bytes:
    top = int(np.abs(x).max(initial=0))
    kind = 1 if top < 1 << 7 else 2 if top < 1 << 15 else 4 if top < 1 << 31 else 8
    return bytes([kind]) + zlib.compress(x.astype(f"<i{kind}").tobytes(), 1)


def _large(b: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(b[1:]), f"<i{b[0]}").astype(np.int64)


def heard_by_words(words: np.ndarray, shapes: np.ndarray, first: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Per word, the sum of the index vectors of both tokens of its neighbours
    up to REACH words away in its text."""
    said = index[words] + index[shapes]
    text = np.searchsorted(first, np.arange(len(words)), "right")
    out = np.zeros_like(said)               # at most 4 x REACH in a place
    for step in range(1, REACH + 1):
        apart = np.flatnonzero(text[step:] != text[:-step])
        before, after = said[:-step].copy(), said[step:].copy()
        before[apart] = after[apart] = 0
        out[step:] += before
        out[:-step] += after
    return out


def add_by_slot(sums: np.ndarray, counts: np.ndarray, tokens: np.ndarray, heard: np.ndarray) -> None:
    """Add the row of ``heard`` of every token to its slot.  Rows are lifted above
    zero and four 16-bit places are added as one 64-bit number; no place
    overflows in the at most LIFTED rows that are added at once."""
    order = np.argsort(tokens.astype(np.uint16), kind="stable")
    begin, size = runs(tokens[order])
    many = -(-size // LIFTED)
    start = np.repeat(begin, many) + LIFTED * spread(np.zeros(len(many), np.int64), many)
    lifted = (heard + np.int8(LIFT)).astype(np.uint16).view(np.uint64)
    total = np.add.reduceat(lifted[order], start, axis=0).view(np.uint16).astype(np.int64)
    length = np.diff(np.append(start, len(order)))
    np.add.at(sums, tokens[order[start]], total - LIFT * length[:, None])
    counts[tokens[order[begin]]] += size


def context_sums(docs: DataFrame) -> DataFrame:
    """(part, sums): per GROUP slots their context sums and token counts."""
    @tidy
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_vectors()
        sums, counts = np.zeros((SLOTS, DIMS), np.int64), np.zeros(SLOTS, np.int64)
        for batch in batches:
            for _, raw, off in blocks(batch):
                words, shapes, first = token_slots(raw, off)
                for lo in range(0, len(words), STEP):           # and REACH words around, heard only
                    a, b = max(0, lo - REACH), min(len(words), lo + STEP + REACH)
                    heard = heard_by_words(words[a:b], shapes[a:b], np.clip(first - a, 0, b - a), index)
                    own = slice(lo - a, min(lo + STEP, len(words)) - a)
                    for tokens in (words[a:b][own], shapes[a:b][own]):
                        add_by_slot(sums, counts, tokens, heard[own])
        table = np.concatenate([sums, counts[:, None]], axis=1)
        parts = [p for p in range(SLOTS // GROUP) if counts[p * GROUP:(p + 1) * GROUP].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(parts, pa.int32()), pa.array([_small(table[p * GROUP:(p + 1) * GROUP]) for p in parts], pa.binary())],
            schema=GROUP_ROW)

    @tidy
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for p, sums in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                totals[p] = totals.get(p, 0) + _large(sums.as_py())
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array([_small(t) for t in totals.values()], pa.binary())],
                                         schema=GROUP_ROW)

    tasks = SLOTS // GROUP
    return (docs.select("text").mapInArrow(gather, "part int, sums binary")
            .repartitionById(tasks, F.col("part")).mapInArrow(add, "part int, sums binary"))


def word_vectors(sums: DataFrame) -> np.ndarray:
    """(SLOTS, DIMS) vectors of unit length without their common direction,
    weighted by how seldom a slot is used.  SLOTS x DIMS numbers, whatever the input."""
    table = np.zeros((SLOTS, DIMS + 1))
    for part, raw in sums.collect():
        table[part * GROUP:(part + 1) * GROUP] = _large(bytes(raw)).reshape(GROUP, DIMS + 1)
    sums_, counts = table[:, :DIMS], table[:, DIMS]
    mean = sums_ / np.maximum(counts, 1)[:, None]
    common = (mean * counts[:, None]).sum(axis=0) / max(1.0, counts.sum())
    mean = np.where(counts[:, None] > 0, mean - common, 0.0)
    unit = mean / np.maximum(np.linalg.norm(mean, axis=1, keepdims=True), 1e-9)
    weight = np.log1p(counts.sum() / np.maximum(counts, 1)) / 10
    return (unit * weight[:, None]).astype(np.float32)


def pooled(raw: np.ndarray, off: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Per text: mean and spread of its word and of its shape vectors."""
    words, shapes, first = token_slots(raw, off)
    out = np.zeros((len(off) - 1, 4 * DIMS), np.float64)
    n = np.maximum(np.diff(first), 1)[:, None]
    text = np.repeat(np.arange(len(off) - 1), np.diff(first))
    # double precision: a score must not depend on the texts it shares a block with
    both = np.concatenate([vectors, vectors * vectors], axis=1, dtype=np.float64)
    for k, total in enumerate((by_pairs(text, words, len(off) - 1, both), by_table(text, shapes, len(off) - 1, both))):
        mean = total[:, :DIMS] / n
        out[:, 2 * k * DIMS:(2 * k + 1) * DIMS] = mean
        out[:, (2 * k + 1) * DIMS:(2 * k + 2) * DIMS] = np.sqrt(np.maximum(total[:, DIMS:] / n - mean ** 2, 0))
    return out


def by_pairs(text: np.ndarray, slots: np.ndarray, texts: int, rows: np.ndarray) -> np.ndarray:
    """Per text, the sum of ``rows`` over its slots; a slot that a text uses
    again is weighted, not gathered again."""
    keys = np.sort(text * SLOTS + slots)
    start, times = runs(keys)
    of, slot = np.divmod(keys[start], SLOTS)
    times = times.astype(np.float64)
    total = np.zeros((texts, rows.shape[1]))
    begin, size = runs(of)
    for i, lo, n in zip(of[begin].tolist(), begin.tolist(), size.tolist(), strict=True):
        if n >= MANY:
            for at in range(lo, lo + n, STEP):
                part = slice(at, min(at + STEP, lo + n))
                total[i] += times[part] @ rows[slot[part]]
    few = np.flatnonzero(np.repeat(size < MANY, size))
    for at in range(0, len(few), STEP):
        part = few[at:at + STEP]
        cut, _ = runs(of[part])
        total[of[part][cut]] += np.add.reduceat(rows[slot[part]] * times[part, None], cut, axis=0)
    return total


def by_table(text: np.ndarray, slots: np.ndarray, texts: int, rows: np.ndarray) -> np.ndarray:
    """The same for few different slots: a table of counts times ``rows``."""
    used, column = np.unique(slots, return_inverse=True)
    total = np.zeros((texts, rows.shape[1]))
    for lo in range(0, texts, TEXTS):
        a, b = np.searchsorted(text, (lo, lo + TEXTS))
        shape = (min(TEXTS, texts - lo), len(used))
        times = np.bincount((text[a:b] - lo) * len(used) + column[a:b], minlength=shape[0] * shape[1]).reshape(shape)
        total[lo:lo + TEXTS] = times.astype(np.float64) @ rows[used]
    return total


class Network:
    """Two layers, trained by Adam on the logistic loss, with a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 5) -> None:
        self.constant = None
        if not len(y) or y.min() == y.max():
            self.constant = 0.5 if not len(y) else (y.sum() + 1) / (len(y) + 2)
            return
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(y))
        seen, kept = order[len(y) // 5:], order[:len(y) // 5]
        self._fit((x[seen] - self.mean) / self.scale, y[seen].astype(float), rng)
        self.temperature = self._calibrate(self.logit(x[kept]), y[kept].astype(float))

    def _fit(self, x: np.ndarray, y: np.ndarray, rng) -> None:
        p = [rng.standard_normal((x.shape[1], HIDDEN)) * np.sqrt(2 / x.shape[1]), np.zeros(HIDDEN),
             rng.standard_normal((HIDDEN, 1)) * np.sqrt(1 / HIDDEN), np.zeros(1)]
        m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
        batch = 64
        for _ in range(max(EPOCHS, 2000 * batch // len(y))):
            order = rng.permutation(len(y))
            for lo in range(0, len(y), batch):
                i = order[lo:lo + batch]
                h = np.maximum(x[i] @ p[0] + p[1], 0)
                e = (1 / (1 + np.exp(-np.clip((h @ p[2])[:, 0] + p[3], -30, 30))) - y[i])[:, None] / len(i)
                back = (e @ p[2].T) * (h > 0)
                grads = [x[i].T @ back + 1e-4 * p[0], back.sum(axis=0), h.T @ e + 1e-4 * p[2], e.sum(axis=0)]
                t += 1
                for k, g in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    p[k] = p[k] - 2e-3 * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
        self.p = p

    def logit(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum(((x - self.mean) / self.scale) @ self.p[0] + self.p[1], 0)
        return (h @ self.p[2])[:, 0] + self.p[3]

    @staticmethod
    def _calibrate(logit: np.ndarray, y: np.ndarray) -> float:
        grid = np.exp(np.linspace(np.log(0.2), np.log(20), 200))
        z = logit[None, :] / grid[:, None]
        loss = (np.logaddexp(0, z) - y * z).sum(axis=1) + PRIOR * np.log(grid) ** 2
        return float(grid[loss.argmin()])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -700, 700)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, Network]:
    vectors = word_vectors(context_sums(docs))
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = (known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))     # at most ``sample`` rows: safe to broadcast

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, raw, off in blocks(batch):
                x = pooled(raw, off, vectors).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).cast(pa.int64()), rows.column(2).cast(pa.int32()),
                     pa.array([row.tobytes() for row in x], pa.binary())], names=["doc_id", "quality", "x"])

    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "quality")
            .mapInArrow(run, "doc_id long, quality int, x binary").dropDuplicates(["doc_id"]).toPandas()
            .sort_values("doc_id"))
    x = np.array([np.frombuffer(b, np.float32) for b in rows["x"]], np.float64).reshape(len(rows), 4 * DIMS)
    return vectors, Network(x, rows["quality"].to_numpy())


def scored(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """(row, score): the columns ``keep`` of ``docs`` as a struct, and the score
    of each text."""
    vectors, network = train(docs, labels)
    rows = docs.select(F.struct(*keep).alias("row"), *(["text"] if "text" not in keep else []))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column(0)               # a text that is kept travels once
            text = batch.column(1) if batch.num_columns > 1 else row.field(keep.index("text"))
            for part, raw, off in blocks(pa.RecordBatch.from_arrays([row, text], names=["row", "text"])):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(network.score(pooled(raw, off, vectors)))],
                                                 names=["row", "score"])

    schema = rows.select("row", F.lit(0.0).alias("score")).schema
    return rows.mapInArrow(run, schema)


def op5_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """held_out, score and predicted label of every document."""
    return scored(docs, labels, ("doc_id",)).select(
        "row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
