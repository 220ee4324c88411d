"""Exact removal of long repeated word sequences, found by recompression.

Recompression names runs and pairs of symbols in rounds.  A symbol is first a
word's hash.  One round (1) names every maximal run of an equal symbol, then
(2) deals all symbols into a left and a right half by a bit of their hash and
names every adjacent left-right pair.  A name is the hash of what it stands
for, so all tasks give equal content the same name without a shared dictionary.
Whether a symbol arises depends on the words of a bounded stretch around it
only (its context, tracked exactly), so equal word sequences have the same
symbols wherever the context lies inside them.

1. Spark counts the top-round symbols over all documents.  A symbol that
   occurs once proves that no window containing its context repeats.
2. The windows left (every contained symbol is shared, or there is none) are
   verified: 64-bit hashes of their words are counted over all documents, in
   buckets that an independent name (a symbol in them) picks.  Two different
   windows of n in b buckets are taken for equal with a chance of n^2 / (b 2^65).
3. Words covered by a window that occurs at least twice are removed.

Texts move once (both later steps read one exchange by row key); symbols and
window hashes move as packed arrays, one packet per map block and bucket.
A value that a block holds twice is known to repeat: only one entry of it is
sent for counting, so a passage that a third of all documents share reaches its
bucket once per block.

Edge cases: null and empty texts have no words; texts shorter than a window
keep everything; repeated rows are further occurrences; a row goes by its id and
text, so texts that share an id, or have none, are apart; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.llm.packets import PACKET_DDL, Sender, answers, found_ranges
from martlens.llm.spans import U64, blocks, hash_spans, mix, spread, tidy, window_hashes, word_spans
from martlens.llm.store import Workspace, partitions

WINDOW = 35
ROUNDS = 6          # symbols of about 6 words, contexts of about 16
SEVERAL = "an id of several texts"      # name of a mark, beside the columns of any input
SYMBOL_BITS = 48    # of a name that travel beside its bucket; clashes only cost a verification


class Symbols:
    """Symbols of a sequence of words: name, word range, context, and whether
    it opens a text."""

    __slots__ = ("first", "hi", "lo", "name", "start")

    def __init__(self, name, start, lo, hi, first) -> None:
        self.name, self.start, self.lo, self.hi, self.first = name, start, lo, hi, first


def _neighbours(s: Symbols, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Context start of the left and context end of the right neighbour.  At
    the edge of a text these lie outside it, so no window contains them."""
    return np.append(-1, s.lo[:-1]), np.append(s.hi[1:], n + 1)


def name_runs(s: Symbols, n: int) -> Symbols:
    """Name every maximal run of an equal symbol; its context takes in both
    neighbours, which end the run."""
    opens = s.first.copy()
    opens[1:] |= s.name[1:] != s.name[:-1]
    opens[:1] = True
    at = np.flatnonzero(opens)
    length = np.diff(np.append(at, len(opens)))
    left, right = _neighbours(s, n)
    name = s.name[at].copy()
    many = length > 1
    name[many] = mix(name[many] ^ mix(length[many].astype(U64)), 1)
    return Symbols(name, s.start[at], left[at], right[at + length - 1], s.first[at])


def name_pairs(s: Symbols, n: int, turn: int) -> Symbols:
    """Name every adjacent pair of a left and a right symbol.  A symbol left
    alone depends on the neighbour it might have joined."""
    is_left = (mix(s.name, 7 + turn) & U64(1)).astype(bool)
    joins = np.zeros(len(is_left), bool)                        # with the next symbol
    joins[:-1] = is_left[:-1] & ~is_left[1:] & ~s.first[1:]
    joined = np.append(False, joins[:-1])[:len(joins)]          # with the one before
    left, right = _neighbours(s, n)
    head = np.flatnonzero(~joined)
    merged = joins[head]
    tail = head + merged
    name = s.name[head].copy()
    name[merged] = mix(mix(s.name[head[merged]], 2) + (s.name[tail[merged]] << U64(1)) + U64(1), 3)
    lo = np.where(merged | is_left[head], s.lo[head], left[head])
    hi = np.where(merged, s.hi[tail], np.where(is_left[head], right[head], s.hi[head]))
    return Symbols(name, s.start[head], lo, hi, s.first[head])


class Parsed:
    """The usable top symbols of a block of texts: those whose context fits
    into a window of their text.  lo and hi ascend."""

    def __init__(self, raw: np.ndarray, off: np.ndarray, window: int, rounds: int = ROUNDS) -> None:
        self.starts, self.ends, self.first = word_spans(raw, off)
        self.words = hash_spans(raw, self.starts, self.ends)
        n = len(self.words)
        at = np.arange(n)
        opens = np.zeros(n + 1, bool)
        opens[self.first] = True
        s = Symbols(self.words, at, at, at + 1, opens[:n])
        if n:
            s = name_runs(s, n)
            for turn in range(rounds):
                s = name_pairs(s, n, turn)
        text = np.searchsorted(self.first, s.start, "right") - 1
        usable = (s.lo >= self.first[text]) & (s.hi <= self.first[text + 1]) & (s.hi - s.lo <= window) if n else at < 0
        self.name, self.lo, self.hi, self.text = s.name[usable], s.lo[usable], s.hi[usable], text[usable]
        self.symbol_first = np.searchsorted(self.text, np.arange(len(off)))


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).to_numpy()


def symbol_packets(docs: DataFrame, buckets: int, window: int) -> DataFrame:
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = Sender(buckets, SYMBOL_BITS)
        for batch in batches:
            for rows, raw, off in blocks(batch):
                p = Parsed(raw, off, window)
                yield from sender.add(_ids(rows)[p.text], np.arange(len(p.text)) - p.symbol_first[p.text],
                                      np.ones(len(p.text), np.int64), p.name, p.name & U64((1 << SYMBOL_BITS) - 1))
        yield from sender.flush()

    return docs.mapInArrow(run, PACKET_DDL)


def _smallest(names: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Smallest of names[lo:hi] for many non-empty ranges."""
    out = np.empty(len(lo), U64)
    level = np.zeros(len(lo), np.int64)
    length = hi - lo
    while (length >> (level + 1)).any():
        level += (length >> (level + 1)) > 0
    table = names
    for k in range(int(level.max(initial=0)) + 1):
        if k:
            half = 1 << (k - 1)
            table = np.minimum(table[:-half], table[half:]) if len(table) > half else table
        at = level == k
        out[at] = np.minimum(table[lo[at]], table[hi[at] - (1 << k)])
    return out


def window_packets(docs: DataFrame, buckets: int, window: int) -> DataFrame:
    """Windows without a symbol that is known to be unique.  Their bucket comes
    from the smallest symbol they contain, so neighbours travel together."""
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = Sender(buckets)
        for batch in batches:
            for rows, raw, off in blocks(batch):
                p = Parsed(raw, off, window)
                n = len(p.words)
                if n < window:
                    continue
                row, first, count = found_ranges(rows.column(2))
                lone = np.ones(len(p.name) + 1, np.int64)
                at = spread(p.symbol_first[row] + first, count)
                lone[at[at < len(p.name)]] = 0
                before = np.append(0, np.cumsum(lone[:-1]))
                start = np.arange(n - window + 1)
                text = np.searchsorted(p.first, start, "right") - 1
                start = start[start + window <= p.first[text + 1]]
                a, b = np.searchsorted(p.lo, start), np.searchsorted(p.hi, start + window, "right")
                b = np.maximum(a, b)
                open_ = before[b] == before[a]
                start, a, b = start[open_], a[open_], b[open_]
                value = window_hashes(p.words, window)[start]
                key = value.copy()
                some = b > a
                key[some] = _smallest(p.name, a[some], b[some])
                text = np.searchsorted(p.first, start, "right") - 1
                new = np.ones(len(start), bool)
                new[1:] = (np.diff(start) != 1) | (np.diff(text) != 0) | (key[1:] != key[:-1])
                head = np.flatnonzero(new)
                yield from sender.add(_ids(rows)[text[head]], start[head] - p.first[text[head]],
                                      np.diff(np.append(head, len(start))), key[head], value)
        yield from sender.flush()

    return docs.mapInArrow(run, PACKET_DDL)


class Kept:
    """A block of texts without the words that found windows cover."""

    def __init__(self, raw: np.ndarray, off: np.ndarray, found: pa.Array, window: int) -> None:
        starts, ends, first = word_spans(raw, off)
        row, at, count = found_ranges(found)
        n = len(starts)
        cover = np.zeros(n + 1, np.int64)
        lo = np.minimum(first[row] + at, first[row + 1])
        hi = np.minimum(first[row] + at + count + window - 1, first[row + 1])
        np.add.at(cover, lo, 1)
        np.add.at(cover, hi, -1)
        keep = np.cumsum(cover[:-1]) == 0
        self.n_words = np.diff(first)
        total = np.append(0, np.cumsum(keep))[first]
        self.n_kept = np.diff(total)
        s, size = starts[keep], (ends - starts)[keep] + 1
        joined = np.append(raw, np.uint8(0x20))[spread(s, size)]
        stop = np.cumsum(size)
        joined[stop - 1] = 0x20                     # one space after every kept word
        self.joined, self.bounds = joined, np.append(0, stop)[total]

    def text(self, i: int) -> bytes:
        """Kept words of a text, joined by one space."""
        lo, hi = self.bounds[i], self.bounds[i + 1]
        return self.joined[lo:max(lo, hi - 1)].tobytes()


def row_keys(docs: DataFrame) -> tuple[DataFrame, Column]:
    """Rows of equal keys have equal texts: the id, which packets hold in a few
    bits, or a hash of id and text below zero where there is no id or it has
    several texts.  Tables that have such ids pay a join for it."""
    several = Workspace(docs.sparkSession, "keys").save(
        docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("lo"), F.max(F.xxhash64("text")).alias("hi"))
        .filter("lo <> hi").select("doc_id"), "several")
    hashed = -1 - F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("long"), "text"), 2)
    if several.isEmpty():
        return docs, F.coalesce(F.col("doc_id").cast("long"), hashed)
    marked = docs.join(several.select("doc_id", F.lit(True).alias(SEVERAL)), "doc_id", "left")
    return marked, F.when(F.col("doc_id").isNull() | F.col(SEVERAL).isNotNull(), hashed).otherwise(F.col("doc_id").cast("long"))


def with_found(docs: DataFrame, buckets: int, window: int = WINDOW) -> DataFrame:
    """owner, text, found (start positions of repeated windows) and the other
    columns of ``docs`` as a struct ``row``."""
    columns = [c for c in docs.columns if c != "text"]
    docs, owner = row_keys(docs)
    base = docs.select(owner.alias("owner"), F.coalesce("text", F.lit("")).alias("text"),
                       F.struct(F.col("text").isNull().alias("__null"), *columns).alias("row"))
    slim = docs.select(owner.alias("owner"), F.coalesce("text", F.lit("")).alias("text"))
    shared = answers(symbol_packets(slim, buckets, window), buckets)
    # same columns in both joins, so that they read one exchange of the texts
    open_ = base.join(shared, "owner", "left").select("owner", "text", "found", "row")
    windows = window_packets(open_, buckets, window)
    return base.join(answers(windows, buckets), "owner", "left").select("owner", "text", "found", "row")


REMOVED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                     ("kept_sha256", pa.string())])


def op7_recompression(spark: SparkSession, docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Words, removed words and the digest of the kept words of every document."""
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, raw, off in blocks(batch):
                k = Kept(raw, off, rows.column(2), window)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).cast(pa.int64()), pa.array(k.n_words), pa.array(k.n_words - k.n_kept),
                     pa.array([hashlib.sha256(k.text(i)).hexdigest() for i in range(rows.num_rows)])], schema=REMOVED)

    found = with_found(docs.select("doc_id", "text"), partitions(spark), window)
    return found.select("row.doc_id", "text", "found").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(spark: SparkSession, docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated words taken out of the text (n_chars follows).
    Texts without a repeat stay as they are, byte for byte."""
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, raw, off in blocks(batch):
                k = Kept(raw, off, rows.column(1), window)
                old = rows.column(0).to_pylist()
                new = [old[i] if k.n_kept[i] == k.n_words[i] else k.text(i).decode() for i in range(rows.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(new, pa.string()), rows.column(2)], names=["text", "row"])

    found = with_found(docs, partitions(spark), window)
    schema = found.select("text", "row").schema
    out = found.select("text", "found", "row").mapInArrow(run, schema)
    text = F.when(~F.col("row.__null"), F.col("text"))
    columns = [text.alias("text") if c == "text" else F.char_length(text).cast(docs.schema[c].dataType).alias(c)
               if c == "n_chars" else F.col(f"row.{c}") for c in docs.columns]
    return out.select(*columns)
