"""Ranked lexical search: an inverted index in shards, read by Block-Max MaxScore.

Index.  Every task turns its documents into shards of bounded text: one row of
document ids and lengths, and one row per term with its posting list.  A list
is cut into blocks of 128 postings, each packed as document gaps and term
frequencies of 1, 2 or 4 bytes.  Its directory holds, per block, the last
document, the place of the block, and its impact pairs: for every power of two
of the term frequency, the largest frequency and the least document length.
From these the greatest score of a block follows for any corpus statistics,
without unpacking it.  The index is a table; it can be stored and searched
again (``build_index``, ``search_index``).

Search.  Corpus counts (documents, terms, document frequencies) are sums over
the index.  Each task reads whole shards, one after another, and keeps a heap of
the k best per query.  With the k-th score as threshold:

* the lists, by ascending greatest score, whose sum stays below the threshold
  are non-essential: a document with no other term cannot enter the heap, so
  only the essential lists give candidates;
* a candidate goes when its score so far and the block maxima of the
  non-essential lists at its place stay below the threshold, and only blocks
  that still hold a candidate are unpacked.

Equal scores are kept until ids are compared, so results are exact.  The heaps
of all tasks are merged by Spark.

Queries reach the tasks in blocks of at most QUERY_BYTES of text (or one query).
The index is limited to the terms asked where the texts of all queries take at
most VOCABULARY_BYTES; beyond that it holds all terms, with the same results.

Terms are the maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``
with A-Z lower-cased, named by 64-bit hashes.

Edge cases: null and empty texts have no terms, are not counted and never
found; a query without terms has no results; repeated rows are documents, or
queries, of their own; a document without an id comes after others of its
score; an empty table gives no rows; other columns may have any names.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlens.llm.packets import join_arrays, split_arrays
from martlens.llm.spans import LOWER, U64, blocks, hash_spans, runs, text_bytes, tidy, word_spans
from martlens.llm.store import Workspace, partitions

TOP = 20
BLOCK = 128                     # postings of a block
SHARD_BYTES = 64 << 20          # text of a shard
QUERY_BYTES = 1 << 20           # query texts that go to the tasks at once
VOCABULARY_BYTES = 64 << 20     # query texts up to which only their terms are indexed
UNPACKED = 20_000               # blocks of a shard that are kept unpacked
FIRST_WINDOW, LAST_WINDOW = 128, 8192   # documents looked at together

_APART = np.ones(256, bool)     # bytes that are in no term
_APART[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
INDEX_DDL = "shard long, term long, n long, total long, directory binary, postings binary"
INDEX = pa.schema([("shard", pa.int64()), ("term", pa.int64()), ("n", pa.int64()), ("total", pa.int64()),
                   ("directory", pa.binary()), ("postings", pa.binary())])
ROWS = 2000                     # rows of an Arrow batch of the index


def term_hashes(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of all texts, and the index of each text's first term."""
    starts, ends, first = word_spans(raw, off, _APART)
    return hash_spans(LOWER[raw], starts, ends), first


# index

def _widths(top: np.ndarray) -> np.ndarray:
    return np.where(top < 1 << 8, 1, np.where(top < 1 << 16, 2, 4))


class _Shard:
    """Postings of the documents of one shard, gathered block by block."""

    def __init__(self, number: int) -> None:
        self.number, self.bytes = number, 0
        self.ids: list[pa.Array] = []
        self.lengths: list[np.ndarray] = []
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.documents = 0

    def add(self, ids: pa.Array, raw: np.ndarray, off: np.ndarray, vocabulary: np.ndarray | None) -> None:
        hashes, first = term_hashes(raw, off)
        length = np.diff(first)
        document = np.repeat(np.arange(len(length)), length)
        if vocabulary is not None and len(vocabulary):
            at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
            hit = vocabulary[at] == hashes
            hashes, document = hashes[hit], document[hit]
        elif vocabulary is not None:
            hashes, document = hashes[:0], document[:0]
        terms, which = np.unique(hashes, return_inverse=True)
        pair, count = np.unique(which.astype(np.int64) * max(1, len(length)) + document, return_counts=True)
        term, document = np.divmod(pair, max(1, len(length)))
        self.held.append((terms[term], (self.documents + document).astype(np.uint32), count.astype(np.uint32)))
        self.ids.append(ids)
        self.lengths.append(length.astype(np.uint32))
        self.documents += len(length)
        self.bytes += len(raw)

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.documents:
            return
        length = np.concatenate(self.lengths)
        ids = pa.chunked_array(self.ids).combine_chunks()
        known = np.asarray(ids.is_valid())
        numbers = ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8")
        yield self._batch([None], [int((length > 0).sum())], [int(length.sum())],
                          [join_arrays(numbers, known.astype("<u1"), length.astype("<u4"))], [b""])
        term, document, count = (np.concatenate(x) for x in zip(*self.held, strict=True))
        if not len(term):
            return
        order = np.argsort(term, kind="stable")         # documents ascend within a term
        term, document, count = term[order], document[order], count[order]
        start, size = runs(term)
        place = np.arange(len(term)) - np.repeat(start, size)
        head = np.flatnonzero(place % BLOCK == 0)       # first posting of every block
        block = np.cumsum(place % BLOCK == 0) - 1
        gap = document.astype(np.int64)
        gap[1:] -= np.where(place[1:] > 0, gap[:-1].copy(), 0)
        n_in = np.diff(np.append(head, len(term)))
        wide, tall = _widths(np.maximum.reduceat(gap, head)), _widths(np.maximum.reduceat(count, head))
        begin = np.append(0, np.cumsum(n_in * (wide + tall)))
        packed = np.zeros(int(begin[-1]), np.uint8)
        inside = np.arange(len(term)) - head[block]
        for values, width, at in ((gap, wide, begin[block] + inside * wide[block]),
                                  (count.astype(np.int64), tall, (begin[:-1] + n_in * wide)[block] + inside * tall[block])):
            for b in range(4):
                some = width[block] > b
                packed[at[some] + b] = values[some] >> 8 * b & 255
        # impact pairs: per block and power of two of the frequency
        level = np.log2(count).astype(np.int64)
        by = np.lexsort((level, block))
        pair_at, _ = runs(block[by] * 64 + level[by])
        pair_block = block[by][pair_at]
        pair_count = np.maximum.reduceat(count[by], pair_at)
        pair_length = np.minimum.reduceat(length[document[by]], pair_at)
        last = document[head + n_in - 1]
        first_block = block[start]
        until_block = np.append(first_block[1:], len(head))
        pair_from, pair_to = np.searchsorted(pair_block, first_block), np.searchsorted(pair_block, until_block)
        code = (wide * 8 + tall).astype("<u1")
        names, totals, directories, postings = [], [], [], []
        for t, (a, b, p, q) in enumerate(zip(first_block.tolist(), until_block.tolist(), pair_from.tolist(), pair_to.tolist(),
                                             strict=True)):
            names.append(int(term[start[t]].astype(np.int64)))
            totals.append(int(size[t]))
            directories.append(join_arrays(last[a:b].astype("<u4"), code[a:b], (begin[a:b] - begin[a]).astype("<u4"),
                                           (pair_block[p:q] - a).astype("<u4"), pair_count[p:q].astype("<u4"),
                                           pair_length[p:q].astype("<u4")))
            postings.append(packed[begin[a]:begin[b]].tobytes())
            if len(names) == ROWS:
                yield self._batch(names, totals, [0] * len(names), directories, postings)
                names, totals, directories, postings = [], [], [], []
        if names:
            yield self._batch(names, totals, [0] * len(names), directories, postings)

    def _batch(self, term, n, total, directory, postings) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(x, t.type) for x, t in zip(([self.number] * len(term), term, n, total, directory, postings), INDEX,
                                                 strict=True)], schema=INDEX)


def build_index(docs: DataFrame, vocabulary: np.ndarray | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Index rows of ``docs`` (doc_id, text).  ``vocabulary``: ascending hashes of
    the only terms to index."""
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        shard = _Shard(number)
        for batch in batches:
            for rows, raw, off in blocks(batch):
                shard.add(rows.column(0), raw, off, vocabulary)
                if shard.bytes >= shard_bytes:
                    yield from shard.rows()
                    number += 1
                    shard = _Shard(number)
        yield from shard.rows()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, INDEX_DDL)


# search

def length_weights(length: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """m of documents by their number of terms: 100 - 25 + (25 n N) div L."""
    if 25 * int(length.max(initial=0)) * documents < 1 << 63:
        return 75 + 25 * length.astype(np.int64) * documents // max(1, terms)
    return np.array([75 + 25 * n * documents // terms for n in length.tolist()], np.int64)


def impact(count: np.ndarray, m: np.ndarray) -> np.ndarray:
    count = count.astype(np.int64)
    return 1_000_000_000 * count // (1000 * count + 12 * m)


class _List:
    """A posting list: block maxima at once, blocks on demand."""

    def __init__(self, n: int, directory: bytes, postings: bytes, weigh: Callable[[np.ndarray], np.ndarray]) -> None:
        last, self.code, self.begin, pair_block, pair_count, pair_length = split_arrays(directory, 6)
        self.last, self.n, self.postings = last.astype(np.int64), n, postings
        at, _ = runs(pair_block)
        self.most = np.maximum.reduceat(impact(pair_count, weigh(pair_length)), at)
        self.top = int(self.most.max())
        self.blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def unpack(self, b: int, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of a block."""
        wide, tall = divmod(int(self.code[b]), 8)
        n, at = min(BLOCK, self.n - b * BLOCK), int(self.begin[b])
        document = np.cumsum(np.frombuffer(self.postings, f"<u{wide}", n, at).astype(np.int64))
        if b:
            document += self.last[b - 1]
        count = np.frombuffer(self.postings, f"<u{tall}", n, at + n * wide)
        return document, impact(count, weights[document])


class _Reader:
    """The lists of one shard."""

    def __init__(self, documents: bytes, lists: dict[int, tuple[int, bytes, bytes]],
                 weigh: Callable[[np.ndarray], np.ndarray]) -> None:
        self.ids, known, length = split_arrays(documents, 3)
        self.nameless = known == 0
        self.weights = weigh(length)
        self.raw, self.weigh = lists, weigh
        self.lists: dict[int, _List] = {}
        self.unpacked = 0

    def __len__(self) -> int:
        return len(self.ids)

    def list(self, term: int) -> _List | None:
        if term not in self.lists and term in self.raw:
            self.lists[term] = _List(*self.raw[term], self.weigh)
        return self.lists.get(term)

    def block(self, of: _List, b: int) -> tuple[np.ndarray, np.ndarray]:
        if b not in of.blocks:
            if self.unpacked >= UNPACKED:
                for x in self.lists.values():
                    x.blocks.clear()
                self.unpacked = 0
            of.blocks[b] = of.unpack(b, self.weights)
            self.unpacked += 1
        return of.blocks[b]


class Heap:
    """The k best documents of a query: by score, then id (none last)."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.score, self.nameless, self.ids = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def threshold(self) -> int:
        """Documents below this score cannot enter."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def offer(self, score: np.ndarray, nameless: np.ndarray, ids: np.ndarray) -> None:
        score, nameless, ids = (np.concatenate(x) for x in ((self.score, score), (self.nameless, nameless), (self.ids, ids)))
        best = np.lexsort((ids, nameless, -score))[:self.k]
        self.score, self.nameless, self.ids = score[best], nameless[best], ids[best]


def search_shard(shard: _Reader, query: list[tuple[int, int]], heap: Heap) -> int:
    """Offer the documents of a shard that can enter to the heap.  ``query``:
    (term, weight) with weights above 0.  Returns the number of blocks whose
    postings were asked for."""
    asked = 0
    lists = [(weight, x) for term, weight in query if (x := shard.list(term)) is not None]
    lists.sort(key=lambda x: x[0] * x[1].top)
    below = np.cumsum([weight * x.top for weight, x in lists])
    lo, width = 0, FIRST_WINDOW
    while lo < len(shard) and lists:
        hi = min(len(shard), lo + width)
        width = min(2 * width, LAST_WINDOW)
        least = heap.threshold()
        essential = int(np.searchsorted(below, least))      # lists[:essential] alone stay below it
        if essential == len(lists):
            return asked
        score, seen = np.zeros(hi - lo, np.int64), np.zeros(hi - lo, bool)
        for weight, x in lists[essential:]:
            for b in range(int(np.searchsorted(x.last, lo)), min(int(np.searchsorted(x.last, hi - 1)) + 1, len(x.last))):
                document, gain = shard.block(x, b)
                asked += 1
                part = slice(*np.searchsorted(document, (lo, hi)))
                score[document[part] - lo] += weight * gain[part]
                seen[document[part] - lo] = True
        found = np.flatnonzero(seen)
        score, found = score[found], found + lo
        rest = list(reversed(lists[:essential]))
        # what the non-essential lists can add at most, by the block a candidate falls into
        places = [np.searchsorted(x.last, found) for _, x in rest]
        most = [weight * np.append(x.most, 0)[at] for (weight, x), at in zip(rest, places, strict=True)]
        open_ = sum(most) if rest else np.zeros(len(found), np.int64)
        alive = np.flatnonzero(score + open_ >= least)
        for (weight, x), at, bound in zip(rest, places, most, strict=True):
            open_ = open_ - bound
            for b in np.unique(at[alive]).tolist():
                if b == len(x.last):
                    continue
                document, gain = shard.block(x, b)
                asked += 1
                mine = alive[at[alive] == b]
                where = np.minimum(np.searchsorted(document, found[mine]), len(document) - 1)
                hit = document[where] == found[mine]
                score[mine[hit]] += weight * gain[where[hit]]
            alive = alive[score[alive] + open_[alive] >= least]
        alive = alive[score[alive] >= least]
        if len(alive):
            heap.offer(score[alive], shard.nameless[found[alive]], shard.ids[found[alive]])
        lo = hi
    return asked


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, dict[int, tuple[int, bytes, bytes]]]]:
    """Shards of rows that are sorted by shard, then term (the document row first)."""
    shard, documents, lists = None, b"", {}
    for batch in batches:
        for s, term, n, directory, postings in zip(*(batch.column(c).to_pylist() for c in (0, 1, 2, 4, 5)), strict=True):
            if s != shard:
                if shard is not None:
                    yield documents, lists
                shard, documents, lists = s, b"", {}
            if term is None:
                documents = directory
            else:
                lists[term] = (n, directory, postings)
    if shard is not None:
        yield documents, lists


def _terms(texts: list[str | None]) -> list[list[int]]:
    raw, off = text_bytes(pa.array(texts, pa.large_string()))
    hashes, first = term_hashes(raw, off)
    hashes = hashes.astype(np.int64).tolist()
    return [hashes[a:b] for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]


def _ask(index: DataFrame, queries: list[tuple[int, list[int]]], documents: int, terms: int, df: dict[int, int],
         k: int, tasks: int) -> DataFrame:
    """The k best of every task: number, doc_id, score."""
    weight = {t: math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for t, n in df.items()}
    plans = [(number, [(t, asked.count(t) * weight[t]) for t in dict.fromkeys(asked) if weight.get(t, 0) > 0])
             for number, asked in queries]
    plans = [p for p in plans if p[1]]
    result = pa.schema([("number", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = {number: Heap(k) for number, _ in plans}
        for of, lists in _by_shard(batches):
            shard = _Reader(of, lists, lambda length: length_weights(length, documents, terms))
            for number, query in plans:
                search_shard(shard, query, heaps[number])
        for number, heap in heaps.items():
            if len(heap.ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(heap.ids), number)), pa.array(heap.ids, mask=heap.nameless), pa.array(heap.score)],
                    schema=result)

    dealt = index.repartition(tasks, "shard").sortWithinPartitions("shard", F.col("term").asc_nulls_first())
    return dealt.mapInArrow(run, "number long, doc_id long, score long")


def search_index(spark: SparkSession, index: DataFrame, queries: DataFrame, ws: Workspace, k: int = TOP) -> DataFrame:
    """number, doc_id, score and rank (from 1) of the k best documents of every
    query (number, text) by a stored index; numbers are unique."""
    corpus = index.filter("term IS NULL").agg(F.sum("n"), F.sum("total")).first()
    documents, terms = corpus[0] or 0, corpus[1] or 0
    size = queries.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // QUERY_BYTES) or 1
    counts = index.filter("term IS NOT NULL").select("term", "n")
    heaps = []
    for part in range(parts):
        rows = queries.filter(F.pmod(F.xxhash64("number"), F.lit(parts)) == part).select("number", "text").collect()
        asked = list(zip([r.number for r in rows], _terms([r.text for r in rows]), strict=True))
        wanted = sorted({t for _, x in asked for t in x})
        if not wanted:
            continue
        of = spark.createDataFrame([(t,) for t in wanted], "term long")     # bounded by QUERY_BYTES
        df = {r.term: r.df for r in counts.join(F.broadcast(of), "term").groupBy("term").agg(F.sum("n").alias("df")).collect()}
        lists = index.join(F.broadcast(of), "term", "left_semi").unionByName(index.filter("term IS NULL"))
        found = _ask(lists.select(*index.columns), asked, documents, terms, df, k, partitions(spark))
        heaps.append(ws.save(found, f"heaps-{part}"))
    best = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    merged = spark.createDataFrame([], "number long, doc_id long, score long")
    for x in heaps:
        merged = merged.unionByName(x)
    return merged.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def asked_terms(queries: DataFrame) -> np.ndarray:
    """Ascending hashes of all terms of the query texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, raw, off in blocks(batch):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(term_hashes(raw, off)[0]).astype(np.int64))], names=["term"])

    rows = queries.select("text").mapInArrow(run, "term long").distinct().collect()
    return np.sort(np.array([r.term for r in rows], np.int64).astype(U64))


def search(spark: SparkSession, docs: DataFrame, queries: DataFrame, k: int = TOP,
           shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents of every row of
    ``queries`` (item_id, text)."""
    ws = Workspace(spark, "search")
    asked = ws.save(queries.select("item_id", "text").withColumn("number", F.monotonically_increasing_id()), "queries")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    vocabulary = asked_terms(asked) if size <= VOCABULARY_BYTES else None
    index = ws.save(build_index(docs, vocabulary, shard_bytes), "index")
    found = search_index(spark, index, asked.select("number", "text"), ws, k)
    return found.join(asked.select("number", "item_id"), "number").select("item_id", F.col("rank").cast("int"), "doc_id", "score")


def op12_ranked_search(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """The 20 best documents of every benchmark item: item_id, rank, doc_id, score."""
    return search(spark, docs, items)


_TERMS = (r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
ORACLE = f"""
WITH words AS (SELECT doc_id, {_TERMS.format('text')} AS w FROM documents WHERE text IS NOT NULL),
documents_ AS (SELECT doc_id, w, CAST(len(w) AS BIGINT) AS n FROM words WHERE len(w) > 0),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM documents_),
postings AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(w) AS term FROM documents_) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
            FROM postings, corpus GROUP BY term),
asked AS (SELECT item_id, term, count(*) AS times
          FROM (SELECT item_id, unnest({_TERMS.format('text')}) AS term FROM benchmark WHERE text IS NOT NULL) GROUP BY ALL),
scores AS (SELECT item_id, doc_id, CAST(sum(times * weight * ((1000000000 * tf) //
                  (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
           FROM asked JOIN postings USING (term) JOIN weights USING (term), corpus GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 20
"""
