"""Words whose polynomial hashes modulo 2^64 are equal: the parity word over two
letters and its complement.  No operator may take one for the other."""

import numpy as np
import pyarrow as pa
import pytest
from brute import jaccard_classes, sha
from samples import make_docs

from martlens.llm import jaccard_join, packing, piece_viterbi, recompression, span_coder, spans, token_files, word_bpe


def parity(n, letters):
    return "".join(letters[bin(i).count("1") & 1] for i in range(n))


SIZES = (1024, 2048, 4096, 8192)
PAIRS = [(parity(n, "ab"), parity(n, "ba")) for n in SIZES]
TEXTS = [(2 * k + j, w) for k, pair in enumerate(PAIRS) for j, w in enumerate(pair)]


@pytest.fixture(scope="module")
def docs(spark):
    return make_docs(spark, TEXTS)


def hashes(words, seed=0):
    raw, off = spans.text_bytes(pa.array(words))
    return spans.hash_spans(raw, off[:-1], off[1:], seed)


def test_spans_of_all_lengths_have_hashes_of_their_own():
    words = sorted({w[:n] for pair in PAIRS for w in pair for n in [*range(1, 70), *SIZES] if n <= len(w)})
    words += ["\0" * n for n in range(1, 40)] + ["a" * n for n in range(100, 140)]
    for seed in (0, 1):
        assert len(set(hashes(words, seed).tolist())) == len(words)
    assert not (hashes(words) == hashes(words, 1)).any()


def test_a_hash_does_not_depend_on_place_or_blocks(monkeypatch):
    words = [w for pair in PAIRS for w in pair] + ["x", "yy" * 40]
    alone = [int(hashes([w])[0]) for w in words]
    assert hashes(words).tolist() == alone
    monkeypatch.setattr(spans, "LANES", 7)
    assert hashes(words).tolist() == alone


def test_join_and_repeats(spark, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.op1_jaccard_join(spark, docs).collect()}
    assert got == jaccard_classes(TEXTS)
    rest = " ".join(f"w{i}" for i in range(34))
    texts = [(i, f"{w} {rest}") for i, w in TEXTS]
    for r in recompression.op7_recompression(spark, make_docs(spark, texts)).collect():
        assert (r.n_removed, r.kept_sha256) == (0, sha(dict(texts)[r.doc_id].split()))


def test_tokens(spark, docs):
    bpe = word_bpe.WordBpe.load(word_bpe.vocabulary_path())
    ids = {i: bpe.tokenizer.encode(w, add_special_tokens=False).ids for i, w in TEXTS}
    crcs = {i: token_files_crc([*x, 1]) for i, x in ids.items()}
    assert {r.doc_id: r.ids_crc32 for r in token_files.op8_token_files(spark, docs).collect()} == crcs
    whole = {r.doc_id: r.ids_crc32 for r in packing.op9_best_fit_packing(spark, docs).collect() if r.start == 0 and
             r.length == len(ids[r.doc_id]) + 1}
    assert whole and all(crcs[i] == c for i, c in whole.items())
    assert all(r.round_trip for r in piece_viterbi.op6_piece_viterbi(spark, docs).collect())


def token_files_crc(ids):
    import zlib
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_spans_that_agree_in_the_first_hash_only(monkeypatch):
    """With a first hash of two bits, the second decides."""
    real = spans.hash_spans

    def weak(raw, starts, ends, seed=0):
        return real(raw, starts, ends, seed) if seed else real(raw, starts, ends) & np.uint64(3)

    monkeypatch.setattr(span_coder, "hash_spans", weak)

    class Letters(span_coder.SpanCoder):
        def _ids(self, texts):
            return [[*t.encode()] for t in texts]

    coder = Letters()
    for text in ("one two three four five", "six one seven two one", "one", ""):
        raw, off = spans.text_bytes(pa.array([text]))
        starts, ends, first = spans.word_spans(raw, off)
        ids, bounds = coder.encode_spans(raw, starts, ends, first)
        assert bytes(ids.astype(np.uint8)).decode() == text.replace(" ", "") and bounds.tolist() == [0, len(ids)]
