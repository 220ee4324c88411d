"""Batch encoding of text spans with a memory of the spans seen.

A subclass says what the ids of a span are; every distinct span of a block is
asked for once, and a worker remembers spans from block to block (bounded, see
CACHE_SPANS).  A span is known by two independent 64-bit hashes: one finds it,
the other must agree too.  Spans that agree in the first only are asked for one
by one and not remembered.
"""

from __future__ import annotations

import numpy as np

from martlens.llm.spans import U64, hash_spans, spread

CACHE_SPANS = 1_000_000     # remembered spans of one worker; beyond it starts afresh
RECENT = 1 << 17


class SpanCoder:
    """Ids of spans by their hash; subclasses provide ``_ids``."""

    def __init__(self) -> None:
        self._clear()

    def _ids(self, spans: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def _clear(self) -> None:
        empty = (np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.main, self.recent = empty, empty       # sorted hashes, second hashes, offsets, lengths
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0

    def _find(self, keys: np.ndarray, level) -> tuple[np.ndarray, np.ndarray]:
        known = level[0]
        if not len(known):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return known[at] == keys, at

    def _learn(self, keys: np.ndarray, proof: np.ndarray, ids: list[list[int]]) -> None:
        offsets, lengths = self._store(ids)
        self.recent = self._merge(self.recent, (keys, proof, offsets, lengths))
        if len(self.recent[0]) > RECENT:
            self.main, self.recent = self._merge(self.main, self.recent), tuple(x[:0] for x in self.recent)

    def _store(self, ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Append id lists to the flat memory: their offsets and lengths."""
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((x for i in ids for x in i), np.uint32, int(lengths.sum()))
        if len(self.flat) < self.used + len(flat):
            self.flat = np.concatenate([self.flat[:self.used], np.zeros(self.used + 2 * len(flat), np.uint32)])
        self.flat[self.used:self.used + len(flat)] = flat
        offsets = self.used + np.cumsum(lengths) - lengths
        self.used += len(flat)
        return offsets, lengths

    @staticmethod
    def _merge(a, b):
        keys = np.concatenate([a[0], b[0]])
        order = np.argsort(keys)
        return tuple(np.concatenate([x, y])[order] for x, y in zip(a, b, strict=True))

    def encode_spans(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                     first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and n + 1 offsets; ``first`` is the first span of each text."""
        names, proof = hash_spans(raw, starts, ends), hash_spans(raw, starts, ends, 1)
        keys, at, inverse = np.unique(names, return_index=True, return_inverse=True)
        if len(self.main[0]) > CACHE_SPANS:
            self._clear()
        in_main, _ = self._find(keys, self.main)
        in_recent, _ = self._find(keys, self.recent)
        new = np.flatnonzero(~(in_main | in_recent))
        if len(new):
            self._learn(keys[new], proof[at[new]], self._ids(_texts(raw, starts, ends, at[new])))
        seconds, offsets, lengths = np.zeros(len(keys), U64), np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        for level in (self.main, self.recent):
            hit, i = self._find(keys, level)
            seconds[hit], offsets[hit], lengths[hit] = level[1][i[hit]], level[2][i[hit]], level[3][i[hit]]
        where, per_span = offsets[inverse], lengths[inverse]
        odd = np.flatnonzero(seconds[inverse] != proof)         # another span of the same first hash
        if len(odd):
            used = self.used
            where[odd], per_span[odd] = self._store(self._ids(_texts(raw, starts, ends, odd)))
            self.used = used                                    # read below, then overwritten
        total = np.zeros(len(per_span) + 1, np.int64)
        np.cumsum(per_span, out=total[1:])
        return self.flat[spread(where, per_span)], total[first]


def _texts(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: np.ndarray) -> list[str]:
    return [raw[a:b].tobytes().decode("utf-8", "replace")
            for a, b in zip(starts[which].tolist(), ends[which].tolist(), strict=True)]
