"""SentencePiece encoding by one pass of an Aho-Corasick automaton.

The automaton holds all ordinary pieces of a model file.  It reads a text
character by character; at each position the output links list every piece
that ends there, and each relaxes the best score of its end from that of its
start (Viterbi).  The best path gives the ids.  Equal scores go to the longer
last piece.  A character that no piece covers costs PENALTY more than the worst
piece and becomes its UTF-8 bytes' pieces (or the unknown piece, where a model
has none).  Decoding joins the pieces' bytes and drops the space that encoding
puts before a text, which gives the text back exactly.

Cutting is exact: no piece goes on past a space that follows another
character, nor contains a character that no piece contains, so a text's best
path is the best paths of its stretches, and a stretch is solved once per block.

The file is a BPE model: its scores are negative merge ranks, no log
probabilities.  The best path over them (n_ids, ids_crc32) is therefore not
what the sentencepiece library gives for this file, which merges the adjacent
pair of the best score until none is left.  MergeCoder gives that segmentation
of the same stretches (n_merge_ids, merge_ids_crc32); its ids are those of
SentencePieceProcessor.encode for any text without U+2581, which the library
reads as a space.

Edge cases: a null or empty text has no ids; the piece character U+2581 inside
a text is coded as bytes, so it survives; repeated rows are coded each; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from martlens.llm.span_coder import SpanCoder
from martlens.llm.spans import blocks, spread, tidy

MODEL = "piece_bpe_32k.model"
PENALTY = 10.0
SPACE_PIECE = "▁"


def model_path(name: str = MODEL) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class PieceAutomaton:
    """Goto, failure and output links over a set of (text, id, score)."""

    def __init__(self, pieces: list[tuple[str, int, float]]) -> None:
        self.goto: dict[tuple[int, str], int] = {}
        self.piece, self.score, self.depth = [-1], [0.0], [0]
        for text, i, score in pieces:
            node = 0
            for c in text:
                step = self.goto.get((node, c))
                if step is None:
                    step = self.goto[node, c] = len(self.piece)
                    self.piece.append(-1)
                    self.score.append(0.0)
                    self.depth.append(self.depth[node] + 1)
                node = step
            if self.piece[node] < 0 or score > self.score[node]:
                self.piece[node], self.score[node] = i, score
        self._link()

    def _link(self) -> None:
        children: dict[int, list[tuple[str, int]]] = {}
        for (node, c), step in self.goto.items():
            children.setdefault(node, []).append((c, step))
        self.fail, self.out = [0] * len(self.piece), [0] * len(self.piece)
        queue = deque([0])
        while queue:
            node = queue.popleft()
            for c, step in children.get(node, ()):
                queue.append(step)
                if node:
                    back = self.fail[node]
                    while back and (back, c) not in self.goto:
                        back = self.fail[back]
                    back = self.goto.get((back, c), 0)
                    self.fail[step] = back
                    self.out[step] = back if self.piece[back] >= 0 else self.out[back]

    def segment(self, text: str, unknown: float) -> list[tuple[int, int, int]]:
        """Best path as (start, end, piece); piece -1 is one uncovered character."""
        goto, fail, out, piece, score, depth = self.goto, self.fail, self.out, self.piece, self.score, self.depth
        best, back, via = [0.0], [0], [-1]
        node = 0
        for i, c in enumerate(text):
            step = goto.get((node, c))
            while step is None and node:
                node = fail[node]
                step = goto.get((node, c))
            node = step or 0
            top, start, which, covered = best[i] + unknown, i, -1, False
            link = node if piece[node] >= 0 else out[node]
            while link:
                s = best[i + 1 - depth[link]] + score[link]
                if depth[link] == 1:
                    covered = True
                if s > top:
                    top, start, which = s, i + 1 - depth[link], piece[link]
                link = out[link]
            if which < 0 and covered:       # a covered character never falls back
                top, which = best[i] + score[goto[0, c]], piece[goto[0, c]]
            best.append(top)
            back.append(start)
            via.append(which)
        path, end = [], len(text)
        while end:
            path.append((back[end], end, via[end]))
            end = back[end]
        return path[::-1]


class PieceCoder(SpanCoder):
    """Encoder and decoder of one model file."""

    _of: dict[str, PieceCoder] = {}

    def __init__(self, path: str) -> None:
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        # inside the automaton the space is a space, so U+2581 itself stays uncovered
        normal = [(model.id_to_piece(i).replace(SPACE_PIECE, " "), i, model.get_score(i)) for i in range(size)
                  if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        if any(" " in text.lstrip(" ") for text, _, _ in normal):
            raise ValueError("a piece goes on past a space; texts cannot be cut at spaces")
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.unknown_id = model.unk_id()
        self.unknown = min(s for _, _, s in normal) - PENALTY
        self.automaton = PieceAutomaton(normal)
        used = {c for text, _, _ in normal for c in text}
        self.apart = np.array([chr(b) not in used and b < 128 for b in range(256)])     # bytes no piece contains
        raw = [text.encode() for text, _, _ in normal]
        table = dict(zip((i for _, i, _ in normal), raw, strict=True)) | {i: bytes([b]) for b, i in self.bytes.items()}
        parts = [table.get(i, b"") for i in range(size)]
        self.lengths = np.array([len(p) for p in parts])
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.raw = np.frombuffer(b"".join(parts), np.uint8)
        super().__init__()

    @classmethod
    def load(cls, path: str) -> PieceCoder:
        if path not in cls._of:
            cls._of[path] = cls(path)
        return cls._of[path]

    def _ids(self, spans: list[str]) -> list[list[int]]:
        out = []
        for text in spans:
            ids: list[int] = []
            for a, b, piece in self.automaton.segment(text, self.unknown):
                if piece >= 0:
                    ids.append(piece)
                else:
                    ids += [self.bytes.get(x, self.unknown_id) for x in text[a:b].encode()] if self.bytes else [self.unknown_id]
            out.append(ids)
        return out

    def encode(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and n + 1 offsets."""
        filled = np.diff(off) > 0
        raw = np.insert(raw, off[:-1][filled], 0x20)        # the space before every text
        off = off + np.append(0, np.cumsum(filled))
        n = len(raw)
        space, apart = raw == 0x20, self.apart[raw]
        new = np.ones(n + 1, bool)
        if n:
            new[1:n] = (space[1:] & ~space[:-1]) | apart[1:] | apart[:-1]
        new[off] = True
        starts = np.flatnonzero(new[:n])
        return self.encode_spans(raw, starts, np.append(starts[1:], n) if n else starts, np.searchsorted(starts, off))

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of all texts and n + 1 offsets."""
        lengths = self.lengths[ids]
        raw = self.raw[spread(self.offsets[ids], lengths)]
        total = np.append(0, np.cumsum(lengths))
        off = total[bounds]
        filled = np.diff(off) > 0
        raw = np.delete(raw, off[:-1][filled])
        return raw, off - np.append(0, np.cumsum(filled))


class MergeCoder(PieceCoder):
    """Encoder by merge order: the library's own ids of a BPE model."""

    _of: dict[str, MergeCoder] = {}

    def __init__(self, path: str) -> None:
        import sentencepiece
        super().__init__(path)
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if any(model.is_unused(i) for i in range(model.get_piece_size())):
            raise ValueError("unused pieces are split again by the library; not built")
        self.table = {model.id_to_piece(i).replace(SPACE_PIECE, " "): (-model.get_score(i), i)
                      for i in range(model.get_piece_size())
                      if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}

    def _merged(self, text: str) -> list[str]:
        """Symbols of a text after all merges, best score first, then leftmost."""
        table = self.table
        n = len(text)
        symbol, after, before = list(text), list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(a: int, b: int) -> None:
            both = symbol[a] + symbol[b]
            if both in table:
                heapq.heappush(heap, (table[both][0], a, both))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, a, both = heapq.heappop(heap)
            b = after[a]
            # a pair of which one side has been merged meanwhile is out of date
            if not symbol[a] or b >= n or symbol[a] + symbol[b] != both:
                continue
            symbol[a], symbol[b] = both, ""
            after[a] = after[b]
            if after[a] < n:
                before[after[a]] = a
                offer(a, after[a])
            if before[a] >= 0:
                offer(before[a], a)
        return [x for x in symbol if x]

    def _ids(self, spans: list[str]) -> list[list[int]]:
        out = []
        for text in spans:
            ids: list[int] = []
            for piece in self._merged(text):
                if piece in self.table:
                    ids.append(self.table[piece][1])
                else:
                    ids += [self.bytes.get(x, self.unknown_id) for x in piece.encode()] if self.bytes else [self.unknown_id]
            out.append(ids)
        return out


CODED = pa.schema([("doc_id", pa.int64()), ("n_ids", pa.int64()), ("ids_crc32", pa.int64()),
                   ("decoded_crc32", pa.int64()), ("round_trip", pa.bool_()),
                   ("n_merge_ids", pa.int64()), ("merge_ids_crc32", pa.int64()), ("merge_round_trip", pa.bool_())])


def op6_piece_viterbi(spark: SparkSession, docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: number of ids, checksum of the ids (little-endian unsigned
    32 bit), checksum of the text decoded from them, and whether that is the
    text byte for byte; then number, checksum and round trip of the library's
    own ids (merge order)."""
    path = path or model_path()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, merger = PieceCoder.load(path), MergeCoder.load(path)

        def coded(by: PieceCoder, raw: np.ndarray, off: np.ndarray) -> tuple[list[pa.Array], pa.Array]:
            """Number, checksum, checksum of the decoded text; round trip."""
            ids, bounds = by.encode(raw, off)
            text, end = by.decode(ids, bounds)
            ids = ids.astype("<u4")
            spans = list(zip(end[:-1].tolist(), end[1:].tolist(), off[:-1].tolist(), off[1:].tolist(), strict=True))
            return ([pa.array(np.diff(bounds)),
                     pa.array([zlib.crc32(ids[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], pa.int64()),
                     pa.array([zlib.crc32(text[a:b]) for a, b, _, _ in spans], pa.int64())],
                    pa.array([np.array_equal(text[a:b], raw[c:d]) for a, b, c, d in spans]))

        for batch in batches:
            for rows, raw, off in blocks(batch):
                best, back = coded(coder, raw, off)
                merged, merged_back = coded(merger, raw, off)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).cast(pa.int64()), *best, back, *merged[:2], merged_back], schema=CODED)

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_ids long, ids_crc32 long, decoded_crc32 long, round_trip boolean, "
             "n_merge_ids long, merge_ids_crc32 long, merge_round_trip boolean")
