"""Best-fit packing of token pieces into sequences under several capacities.

Every sequence has room for tokens, documents and attention cost (the sum of
squared piece lengths).  Pieces are taken from long to short; among the open
sequences that hold a piece under every capacity, the one whose weighted
residual vector after taking it has the smallest norm (or, on request, the
largest weighted dot product with the piece) gets it.

Pieces are dealt over tasks by a hash of (doc_id, piece) and packed in groups
of at most GROUP_PIECES, so a group costs at most one part-filled sequence.
The query has as many tasks as full groups, by the number of pieces.

Edge cases: a null or empty text has one piece, the end id; texts longer than
a sequence are cut, only their last piece may be short; a sequence that a
capacity closes early is simply left; repeated rows are packed each; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.llm.spans import blocks, tidy
from martlens.llm.store import Workspace
from martlens.llm.word_bpe import WordBpe, vocabulary_path

SEQUENCE_TOKENS = 4096
GROUP_PIECES = 16384
# Of the registered query: capacities beside tokens that never bind.
MAX_DOCUMENTS = SEQUENCE_TOKENS
MAX_COST = SEQUENCE_TOKENS ** 2
WEIGHTS = (1.0, 1e-3, 1e-3)     # tokens, documents, attention cost

PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                    ("length", pa.int32()), ("ids_crc32", pa.int64())])
PIECES_DDL = "doc_id long, piece int, start long, length int, ids_crc32 long"


def token_pieces(docs: DataFrame, path: str, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """The pieces of every document: at most ``size`` ids each."""
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordBpe.load(path)
        for batch in batches:
            for rows, raw, off in blocks(batch):
                ids, bounds = encoder.encode(raw, off)
                ids = ids.astype("<u4")
                n = np.diff(bounds)
                count = -(-n // size)
                doc = np.repeat(np.arange(len(n)), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                length = np.minimum(n[doc] - piece * size, size)
                at = bounds[doc] + piece * size
                crc = [zlib.crc32(ids[a:a + b]) for a, b in zip(at.tolist(), length.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).cast(pa.int64()).take(pa.array(doc)), pa.array(piece.astype(np.int32)),
                     pa.array(piece * size), pa.array(length.astype(np.int32)), pa.array(crc, pa.int64())],
                    schema=PIECES)

    return docs.select("doc_id", "text").mapInArrow(run, PIECES_DDL)


def best_fit(lengths: np.ndarray, tokens: int = SEQUENCE_TOKENS, documents: int = MAX_DOCUMENTS,
             cost: int = MAX_COST, weights: tuple[float, float, float] = WEIGHTS,
             by: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece; pieces come longest first.

    A piece that no empty sequence could hold under the cost capacity gets a
    sequence of its own.
    """
    room = np.array([tokens, documents, cost], float)
    scale = np.sqrt(np.array(weights)) / room
    need = np.stack([lengths, np.ones(len(lengths)), lengths.astype(float) ** 2], axis=1)
    smallest = np.minimum.accumulate(need[::-1], axis=0)[::-1] if len(need) else need
    left = np.empty((len(lengths), 3))          # residuals of open sequences, in opening order
    name = np.empty(len(lengths), np.int64)
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened = used = 0
    for i, want in enumerate(need):
        if i % 256 == 0 and used:               # drop sequences that hold none of the rest
            keep = (left[:used] >= smallest[i]).all(axis=1)
            used_now = int(keep.sum())
            left[:used_now], name[:used_now] = left[:used][keep], name[:used][keep]
            used = used_now
        fits = np.flatnonzero((left[:used] >= want).all(axis=1))
        if len(fits):
            if by == "norm":
                score = (((left[fits] - want) * scale) ** 2).sum(axis=1)
                best = fits[score.argmin()]
            else:
                best = fits[((left[fits] * scale) @ (want * scale)).argmax()]
        else:
            best, used = used, used + 1
            left[best], name[best] = room, opened
            opened += 1
        sequence[i], offset[i] = name[best], tokens - left[best, 0]
        left[best] -= want
    return sequence, offset


def pack(pieces: DataFrame, tasks: int, tokens: int = SEQUENCE_TOKENS, documents: int = MAX_DOCUMENTS,
         cost: int = MAX_COST, weights: tuple[float, float, float] = WEIGHTS, by: str = "norm") -> DataFrame:
    """Pieces with sequence_id and offset."""
    schema = pa.schema([*PIECES, ("sequence_id", pa.int64()), ("offset", pa.int32())])

    def group(table: pa.Table, base: int) -> tuple[pa.RecordBatch, int]:
        lengths = table.column("length").to_numpy().astype(np.int64)
        whole = lengths >= tokens               # fill a sequence alone
        sequence = np.empty(len(lengths), np.int64)
        offset = np.zeros(len(lengths), np.int64)
        sequence[whole] = np.arange(int(whole.sum()))
        seq, off = best_fit(lengths[~whole], tokens, documents, cost, weights, by)
        sequence[~whole], offset[~whole] = seq + int(whole.sum()), off
        out = pa.RecordBatch.from_arrays(
            [*(c.combine_chunks() for c in table.columns), pa.array(sequence + base),
             pa.array(offset.astype(np.int32))], schema=schema)
        return out, base + int(sequence.max(initial=-1)) + 1

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        held: list[pa.RecordBatch] = []
        rows = 0
        for b in batches:
            for lo in range(0, b.num_rows, GROUP_PIECES):
                held.append(b.slice(lo, GROUP_PIECES))
                rows += held[-1].num_rows
                if rows >= GROUP_PIECES:
                    out, base = group(_sorted(held), base)
                    held, rows = [], 0
                    yield out
        if rows:
            yield group(_sorted(held), base)[0]

    def _sorted(held: list[pa.RecordBatch]) -> pa.Table:
        return pa.Table.from_batches(held).cast(PIECES).sort_by(
            [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])

    # by the place in the stored table too: pieces that share an id, or have none, are dealt like others
    dealt = pieces.repartition(tasks, F.xxhash64("doc_id", "piece", F.monotonically_increasing_id())) \
        .sortWithinPartitions("doc_id", "piece")
    return dealt.mapInArrow(run, f"{PIECES_DDL}, sequence_id long, offset int")


def op9_best_fit_packing(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    pieces = Workspace(spark, "packing").save(token_pieces(docs, vocabulary_path()), "pieces")
    tasks = -(-pieces.count() // GROUP_PIECES)          # full groups, whatever the session's partitions
    return pack(pieces, max(1, tasks))
