"""Batch encoding of Arrow text with a word-level BPE vocabulary.

The vocabulary drops white space and splits letters from punctuation before it
merges, so the ids of a text are the ids of its pieces between such places,
one after another.  Texts are cut there in numpy, each distinct piece is
encoded once by the tokenizers library (see span_coder).
"""

from __future__ import annotations

import os

import numpy as np

from martlens.llm.span_coder import SpanCoder
from martlens.llm.spans import _SPACE, LOWER

VOCABULARY = "word_bpe_49k.json"
END_ID = 1

# Byte classes: 1 ASCII letter, 2 ASCII punctuation at whose edge a piece may
# be cut.  The apostrophe (contractions) and the bar (special tokens) are not.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(65, 91), *range(97, 123)]] = 1
_CLASS[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in "'|"]] = 2


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def piece_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and first index per text of the independent pieces."""
    n = len(raw)
    solid = ~_SPACE[raw]
    kind = _CLASS[raw]
    new = np.ones(n + 1, bool)          # does something new begin at this byte
    if n:
        new[1:n] = ~(solid[1:] & solid[:-1]) | ((kind[1:] ^ kind[:-1]) == 3)
    new[off] = True
    starts = np.flatnonzero(solid & new[:n])
    ends = np.flatnonzero(solid & new[1:]) + 1
    return starts, ends, np.searchsorted(starts, off)


def _byte_letters() -> list[str]:
    """The printable stand-in of every byte that byte-level vocabularies use:
    printable Latin-1 stays, the rest is numbered on from 256."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, free = [], 256
    for b in range(256):
        out.append(chr(b if b in keep else free))
        free += b not in keep
    return out


class WordBpe(SpanCoder):
    """Encoder of one vocabulary file with its memory of pieces."""

    _of: dict[str, WordBpe] = {}

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        super().__init__()

    @classmethod
    def load(cls, path: str) -> WordBpe:
        if path not in cls._of:
            cls._of[path] = cls(path)
        return cls._of[path]

    def _ids(self, pieces: list[str]) -> list[list[int]]:
        """Ids of pieces; plain Latin words go to the merges directly, as
        normalising and splitting leaves them whole."""
        out: list[list[int] | None] = []
        rest = []
        for p in pieces:
            low = p.lower()
            if low.isalpha() and max(low) < "ɐ":
                out.append([t.id for t in self.model.tokenize("".join([self.letters[b] for b in low.encode()]))])
            else:
                rest.append(len(out))
                out.append(None)
        for i, e in zip(rest, self.tokenizer.encode_batch([pieces[i] for i in rest], add_special_tokens=False),
                        strict=True):
            out[i] = e.ids
        return out

    def encode(self, raw: np.ndarray, off: np.ndarray, end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (with the end id appended to each) and n + 1 offsets."""
        if b"<|" not in raw.tobytes():              # special tokens are matched before lower-casing
            raw = LOWER[raw]
        ids, bounds = self.encode_spans(raw, *piece_spans(raw, off))
        if end_id is not None:
            ids = np.insert(ids, bounds[1:], np.uint32(end_id))
            bounds = bounds + np.arange(len(bounds))
        return ids, bounds
