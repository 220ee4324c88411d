"""Periodic runs of words by enumerating maximal pairs on an LCP-interval tree.

A run is a maximal stretch of words with smallest period q (words q apart are
identical) that is at least ``exponent`` periods and ``shortest`` words long.
Two occurrences i < j of a word sequence are a maximal pair when neither the
words before nor the words after them agree; with lcp(i, j) = l the stretch
[i, j + l) has period j - i and ends on both sides.  So the maximal pairs whose
distance d satisfies l >= (exponent - 1) * d and l + d >= ``shortest`` are
exactly the runs, and nothing has to be extended.

1. Positions whose first BASE words occur once in their text are in no such
   pair (l >= BASE there) and are left out by one sort of hashes.
2. The suffixes at the other positions are sorted by prefix doubling; the kept
   ranks of each round give the LCP of neighbours by binary descent.
3. The LCP-interval tree is walked bottom-up with a stack.  An interval keeps
   the positions below it in ascending order, each with the class of its left
   word.  When a child joins its interval, the smaller list goes into the
   larger; a position is paired with its neighbours of another left-word
   class.  Farther positions need no look: as l >= 2 d, occurrences that
   lie between i and j are themselves one period apart, so a pair over them has
   a multiple of the period, and a pair found that way before the nearer
   position arrived is dropped in favour of the smaller period.

All of it is numpy on blocks of texts, but for the walk over intervals that
hold three positions or more and a pair near enough.  There is no shuffle: a
text is one row.  Memory follows the block or the longest text.

Words are compared by 64-bit hashes (see spans.hash_spans) within one text.

Edge cases: null and empty texts have no words and no run; repeated rows are
worked on each for itself; an empty table gives no rows; other columns may have
any names and are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.llm.spans import U64, blocks, hash_spans, mix, runs, spread, tidy, window_hashes, word_spans

SHORTEST = 6
EXPONENT = 4        # at least 3, which the third step relies on
FEW = 32            # lists of up to so many times the smaller one are merged by sorting


def base_width(shortest: int, exponent: int) -> int:
    """Least lcp of a pair that is a run."""
    return min(max((exponent - 1) * q, shortest - q) for q in range(1, shortest + 1))


class _Suffixes:
    """Suffixes at the positions whose first ``base`` words repeat, in
    lexicographic order of word hashes: ``order``, ``lcp`` with the one before
    (0 where the first ``base`` words differ)."""

    def __init__(self, words: np.ndarray, base: int) -> None:
        n = len(words)
        self.base = base
        self.words = np.concatenate([words, mix(np.arange(2 * base).astype(U64), 61)])
        gram = window_hashes(words, base)
        by_gram = np.argsort(gram)
        start, size = runs(gram[by_gram])
        some = np.sort(by_gram[np.repeat(size > 1, size)])
        self.order, self.lcp = some, np.zeros(len(some), np.int64)
        if not len(some):
            return
        # every position that a round below asks for is one of these
        self.at = np.unique(np.concatenate([some, some + base]))
        self.index = np.full(n + base + 1, -1, np.int32)
        self.index[self.at] = np.arange(len(self.at))
        columns = [self.words[self.at + k] for k in range(base)]
        by = np.lexsort(columns[::-1])
        new = np.zeros(len(by), bool)
        new[:1] = True
        for c in columns:
            new[1:] |= c[by[1:]] != c[by[:-1]]
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(by)))
        rank = np.empty(len(by), np.int64)          # place of the first suffix with the same prefix
        rank[by] = np.repeat(start, size)
        self.levels = [(base, rank)]
        width, open_ = base, by[np.repeat(size > 1, size)]
        while len(open_):
            after = rank[self.index[self.at[open_] + width]]
            by = np.lexsort((after, rank[open_]))
            open_, after, old = open_[by], after[by], rank[open_][by]
            splits = np.append(True, old[1:] != old[:-1])
            new = splits.copy()
            new[1:] |= after[1:] != after[:-1]
            start = np.flatnonzero(new)
            size = np.diff(np.append(start, len(open_)))
            opened = np.flatnonzero(splits)
            opened = opened[np.searchsorted(opened, start, "right") - 1]
            rank = rank.copy()
            rank[open_] = np.repeat(old[start] + start - opened, size)
            width *= 2
            open_ = open_[np.repeat(size > 1, size)]
            if len(open_):
                self.levels.append((width, rank))
        self.order = some[np.argsort(rank[self.index[some]])]
        first = self.levels[0][1][self.index[self.order]]
        self.lcp[1:] = np.where(first[1:] == first[:-1], self._common(self.order[:-1], self.order[1:]), 0)

    def _common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x), np.int64)
        for width, rank in reversed(self.levels):
            a, b = self.index[x + total], self.index[y + total]
            total += width * ((a >= 0) & (b >= 0) & (rank[a] == rank[b]))
        going = np.ones(len(x), bool)
        for _ in range(self.base - 1):
            going &= self.words[x + total] == self.words[y + total]
            total += going
        return total


def _walk(order: list[int], lcp: list[int], left: np.ndarray, exponent: int, shortest: int,
          out: list[tuple[int, int, int]]) -> None:
    """Pairs of one group of suffixes, bottom-up over its LCP intervals."""
    stack: list[tuple[int, list[int]]] = []
    for t, position in enumerate(order):
        places = [position]
        nxt = lcp[t + 1] if t + 1 < len(order) else 0
        while stack and stack[-1][0] >= nxt:
            depth, others = stack.pop()
            large, small = (others, places) if len(others) >= len(places) else (places, others)
            reach = depth // (exponent - 1)
            for x in small:
                k = bisect_left(large, x)
                for y in (large[k - 1:k] + large[k:k + 1]) if k else large[:1]:
                    i, j = (x, y) if x < y else (y, x)
                    if j - i <= reach and left[i] != left[j] and depth + j - i >= shortest:
                        out.append((i, depth + j - i, j - i))
            if len(small) * FEW < len(large):
                for x in small:
                    insort(large, x)
            else:
                large += small
                large.sort()
            places = large
            if depth == nxt:
                break
        stack.append((nxt, places))


def find_runs(words: np.ndarray, text: np.ndarray, shortest: int = SHORTEST,
              exponent: int = EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of all runs, by start, then period.
    ``words`` are hashes, ``text`` the number of each word's text."""
    base = base_width(shortest, exponent)
    own = mix(words ^ mix(text.astype(U64), 62), 63)        # words of different texts never agree
    s = _Suffixes(own, base)
    found: list[tuple[int, int, int]] = []
    if len(s.order):
        left = np.append(mix(np.full(1, len(own), U64), 64), own)     # class of the word before a position
        head = np.flatnonzero(s.lcp == 0)
        size = np.diff(np.append(head, len(s.order)))
        # a group can hold a run only if its nearest positions are near enough for its deepest interval
        group = np.repeat(np.arange(len(head)), size)
        by = s.order[np.lexsort((s.order, group))]
        gap = np.append(np.diff(by), 0)
        gap[head[1:] - 1] = np.iinfo(np.int64).max
        gap[-1] = np.iinfo(np.int64).max
        near = np.minimum.reduceat(gap, head) <= np.maximum.reduceat(s.lcp, head) // (exponent - 1)
        two = head[near & (size == 2)]
        i, j, depth = np.minimum(s.order[two], s.order[two + 1]), np.maximum(s.order[two], s.order[two + 1]), s.lcp[two + 1]
        good = (left[i] != left[j]) & (depth + j - i >= shortest)
        found += zip(i[good].tolist(), (depth + j - i)[good].tolist(), (j - i)[good].tolist(), strict=True)
        for a, n in zip(head[near & (size > 2)].tolist(), size[near & (size > 2)].tolist(), strict=True):
            _walk(s.order[a:a + n].tolist(), s.lcp[a:a + n].tolist(), left, exponent, shortest, found)
    start, length, period = np.array(found, np.int64).reshape(-1, 3).T
    by = np.lexsort((period, length, start))
    start, length, period = start[by], length[by], period[by]
    smallest = np.ones(len(by), bool)
    smallest[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[smallest], length[smallest], period[smallest]
    by = np.lexsort((period, start))
    return start[by], length[by], period[by]


class Block:
    """Words, runs and kept words of a block of texts.  ``source`` may say, for
    every word, which word of the block stands in its place."""

    def __init__(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray,
                 source: np.ndarray | None = None) -> None:
        words = hash_spans(raw, starts, ends)
        if source is not None:
            words, starts, ends = words[source], starts[source], ends[source]
        self.first, n = first, len(words)
        self.n_words = np.diff(first)
        text = np.repeat(np.arange(len(first) - 1), self.n_words)
        self.start, self.length, self.period = find_runs(words, text)
        self.run_first = np.searchsorted(self.start, first)
        cover = np.zeros(n + 1, np.int64)
        np.add.at(cover, self.start + self.period, 1)
        np.add.at(cover, self.start + self.length, -1)
        keep = np.cumsum(cover[:-1]) == 0
        size = (ends - starts)[keep] + 1
        joined = np.append(raw, np.uint8(0x20))[spread(starts[keep], size)]
        stop = np.cumsum(size)
        joined[stop - 1] = 0x20                     # one space after every kept word
        self.joined = joined
        self.bounds = np.append(0, stop)[np.append(0, np.cumsum(keep))[first]]

    def kept(self, i: int) -> bytes:
        lo, hi = self.bounds[i], self.bounds[i + 1]
        return self.joined[lo:max(lo, hi - 1)].tobytes()

    def runs(self, i: int) -> np.ndarray:
        """(start, length, period) rows of a text, starts counted from its first word."""
        part = slice(self.run_first[i], self.run_first[i + 1])
        return np.stack([self.start[part] - self.first[i], self.length[part], self.period[part]], axis=1)


def looped_tails(ids: list[int | None], first: np.ndarray) -> np.ndarray:
    """Source of each word when the last part of every tenth text is made to
    repeat: with h = crc32(decimal id) and g = h // 10, where h % 10 = 0 words
    i >= a = g % n become word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8)."""
    source = np.arange(first[-1])
    for i, x in enumerate(ids):
        n = int(first[i + 1] - first[i])
        h = zlib.crc32(str(x).encode()) if x is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            source[first[i] + a:first[i + 1]] = first[i] + a + np.arange(n - a) % p
    return source


def collapse_runs(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with every run cut down to its first period, words joined by one
    space; a text without a run stays as it is, byte for byte.  A column ``runs``
    (start, length, period) is added in front."""
    schema = F.struct(docs["text"], F.struct("*").alias("row"))
    packed = docs.select(F.col("text"), schema.getField("row").alias("row"))
    out = "runs array<struct<start:long,length:long,period:long>>, text string, row " + packed.schema["row"].dataType.simpleString()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            for rows, raw, off in blocks(batch):
                b = Block(raw, *word_spans(raw, off))
                found = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in b.runs(i).tolist()]
                         for i in range(rows.num_rows)]
                old = rows.column(0).to_pylist()
                new = [b.kept(i).decode() if found[i] else old[i] for i in range(rows.num_rows)]
                yield pa.RecordBatch.from_arrays([pa.array(found, kind), pa.array(new, pa.string()), rows.column(1)],
                                                 names=["runs", "text", "row"])

    done = packed.mapInArrow(run, out)
    return done.select("runs", *[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


RESULT = pa.schema([("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()),
                    ("collapsed_sha256", pa.string())])


def op11_periodic_runs(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document, with looped tails (see ``looped_tails``; none without an
    id): the number of runs, the longest one, and digests of all runs and of
    the kept words."""
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, raw, off in blocks(batch):
                starts, ends, first = word_spans(raw, off)
                ids = rows.column(0).to_pylist()
                b = Block(raw, starts, ends, first, looped_tails(ids, first))
                out = []
                for i, x in enumerate(ids):
                    found = b.runs(i).tolist()
                    s, n, p = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
                    lines = "".join(f"{a},{b},{c}\n" for a, b, c in found)
                    out.append((x, len(found), s, n, p, n and 1000 * n // p,
                                hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b.kept(i)).hexdigest()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), RESULT, strict=True)], schema=RESULT)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
             "runs_sha256 string, collapsed_sha256 string")
