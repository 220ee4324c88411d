"""Token files, packing and piece coding."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from samples import EDGE_TEXTS, ROUGH_TEXTS, SF
from hypothesis import given, settings
from hypothesis import strategies as st

from martlens.llm import packing, piece_viterbi, spans, token_files, word_bpe
from martlens.llm.queries import QUERIES
from martlens.llm.store import Workspace


@pytest.fixture(scope="module")
def bpe():
    return word_bpe.WordBpe.load(word_bpe.vocabulary_path())


def ids_of(bpe, texts):
    return [np.array(e.ids + [1], "<u4") for e in
            bpe.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.asarray(ids).astype("<u4").tobytes())


def text_batch(texts):
    return pa.record_batch({"text": pa.array(texts, pa.string())})


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \t\n'|<>.,!aZsédÉ1½İß\u0301\u2581中"), st.characters(codec="utf-8")),
                        max_size=40), max_size=6))
def test_pieces_give_the_ids_of_whole_texts(texts):
    bpe = word_bpe.WordBpe.load(word_bpe.vocabulary_path())
    got = []
    for _, raw, off in spans.blocks(text_batch(texts)):
        ids, at = bpe.encode(raw, off)
        got += [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
    assert got == [x.tolist() for x in ids_of(bpe, texts)]


def token_rows(bpe, texts):
    out, start = [], 0
    ordered = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    for (i, _), ids in zip(ordered, ids_of(bpe, [t for _, t in ordered]), strict=True):
        out.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def test_token_files(spark, bpe, edge_docs, rough_docs, no_docs):
    for docs, texts in ((edge_docs, EDGE_TEXTS), (rough_docs, ROUGH_TEXTS)):
        rows = sorted((tuple(r) for r in token_files.op8_token_files(spark, docs).collect()), key=lambda r: r[1])
        assert rows == token_rows(bpe, texts)
    assert token_files.op8_token_files(spark, no_docs).count() == 0


def test_registered_token_files(spark, bpe, sf_docs):
    texts = [(r.doc_id, r.text) for r in sf_docs.select("doc_id", "text").collect()]
    rows = sorted((tuple(r) for r in QUERIES["op8_token_files"](spark, SF).collect()), key=lambda r: r[1])
    assert rows == token_rows(bpe, texts)


def test_many_files(spark, bpe, sf_docs):
    segments = token_files.write_token_files(sf_docs, word_bpe.vocabulary_path(), Workspace(spark, "t"), 6, segment_ids=3000)
    assert segments.count() > 4
    assert token_files.read_token_files(segments).count() == sf_docs.count()


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 5000), st.integers(1, 70000), st.integers(0, 10 ** 6))
def test_range_coder_round_trip(kinds, n, seed):
    rng = np.random.default_rng(seed)
    ids = (rng.pareto(1.0, n) * kinds).clip(0, 49407).astype(np.uint32)
    record = token_files.encode_segment(ids)
    assert (token_files.decode_segment(n, record) == ids).all()


def test_all_symbols_and_a_broken_block():
    ids = np.append(np.arange(49408), np.zeros(100000)).astype(np.uint32)
    record = token_files.encode_segment(ids)
    assert (token_files.decode_segment(len(ids), record) == ids).all()
    assert len(record["words"]) < 2 * len(ids)
    words = bytearray(record["words"])
    words[1000] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        token_files.decode_segment(len(ids), record | {"words": bytes(words)})


def test_frequencies_sum_to_the_scale():
    for counts in ([1], [1] * 40000, [10 ** 9, 1], [5, 5, 5], list(range(1, 30000))):
        f = token_files.quantise(np.array(counts))
        assert f.sum() == 1 << 16 and f.min() >= 1


# packing

def check_packing(bpe, rows, texts):
    want = []
    for (i, _), ids in zip(texts, ids_of(bpe, [t for _, t in texts]), strict=True):
        for p, lo in enumerate(range(0, len(ids), 4096)):
            part = ids[lo:lo + 4096]
            want.append((str(i), p, lo, len(part), crc(part)))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096
    return len(by), sum(w[3] for w in want)


def test_packing(spark, bpe, edge_docs, rough_docs, no_docs):
    check_packing(bpe, packing.op9_best_fit_packing(spark, edge_docs).collect(), EDGE_TEXTS)
    check_packing(bpe, packing.op9_best_fit_packing(spark, rough_docs).collect(), ROUGH_TEXTS)
    assert packing.op9_best_fit_packing(spark, no_docs).count() == 0


def test_registered_packing_is_near_the_bound(spark, bpe, sf_docs):
    texts = [(r.doc_id, r.text) for r in sf_docs.select("doc_id", "text").collect()]
    used, tokens = check_packing(bpe, QUERIES["op9_best_fit_packing"](spark, SF).collect(), texts)
    assert used <= -(-tokens // 4096) + 8 + 2       # a part-filled one for each of 8 tasks


def test_packing_does_not_depend_on_the_session_s_partitions(spark, bpe, sf_docs):
    texts = [(r.doc_id, r.text) for r in sf_docs.select("doc_id", "text").collect()]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "120")
    try:
        used, tokens = check_packing(bpe, packing.op9_best_fit_packing(spark, sf_docs).collect(), texts)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    print("sequences", used, "least", -(-tokens // 4096))
    assert used <= -(-tokens // 4096) + 2


def plain_best_fit(lengths, tokens, documents, cost):
    """The rule in plain Python, one piece and one sequence at a time."""
    room = []
    out = []
    weights = packing.WEIGHTS
    for n in lengths:
        want = (n, 1, n * n)
        scores = []
        for k, left in enumerate(room):
            rest = [a - b for a, b in zip(left, want, strict=True)]
            if min(rest) >= 0:
                scores.append((sum(w * (r / c) ** 2 for w, r, c in zip(weights, rest, (tokens, documents, cost), strict=True)), k))
        k = min(scores)[1] if scores else len(room)
        if not scores:
            room.append((tokens, documents, cost))
        out.append(k)
        room[k] = tuple(a - b for a, b in zip(room[k], want, strict=True))
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60), st.integers(1, 6), st.integers(10_000, 12_000))
def test_best_fit_keeps_every_capacity(lengths, documents, cost):
    lengths = np.array(sorted(lengths, reverse=True), np.int64)
    for by in ("norm", "dot"):
        sequence, offset = packing.best_fit(lengths, 100, documents, cost, by=by)
        for s in np.unique(sequence):
            n = lengths[sequence == s]
            assert n.sum() <= 100 and len(n) <= documents and (n * n).sum() <= cost
            assert sorted(offset[sequence == s].tolist()) == np.sort(np.cumsum(n) - n).tolist()
    assert packing.best_fit(lengths, 100, documents, cost)[0].tolist() == plain_best_fit(lengths.tolist(), 100, documents, cost)


# pieces

@pytest.fixture(scope="module")
def pieces():
    return piece_viterbi.PieceCoder.load(piece_viterbi.model_path())


def plain_viterbi(pieces, text):
    """Best score over all segmentations by plain dynamic programming."""
    if not text:
        return []
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=piece_viterbi.model_path())
    table = {model.id_to_piece(i).replace("▁", " "): (i, model.get_score(i)) for i in range(model.get_piece_size())
             if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    text = " " + text
    best = [(0.0, [])]
    for end in range(1, len(text) + 1):
        top = None
        for start in range(max(0, end - 16), end):      # longest last piece first
            if piece := table.get(text[start:end]):
                score = best[start][0] + piece[1]
                if top is None or score > top[0]:
                    top = (score, [*best[start][1], piece[0]])
        if top is None:
            top = (best[end - 1][0] + pieces.unknown, best[end - 1][1] + [pieces.bytes[b] for b in text[end - 1].encode()])
        best.append(top)
    return best[-1][1]


@pytest.mark.parametrize("text", ["", " ", "  two  spaces ", "plain words here", "Ünï ▁ under\tTab\r\n;\r x", "日本語 テスト 😀",
                                  "a" * 50, "x\x00y", "\n\n lead", "return {\r"])
def test_pieces_match_plain_viterbi(pieces, text):
    raw, off = spans.text_bytes(pa.array([text]))
    ids, _ = pieces.encode(raw, off)
    assert ids.tolist() == plain_viterbi(pieces, text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=5))
def test_pieces_round_trip(texts):
    pieces = piece_viterbi.PieceCoder.load(piece_viterbi.model_path())
    raw, off = spans.text_bytes(pa.array(texts, pa.string()))
    back, end = pieces.decode(*pieces.encode(raw, off))
    assert [back[a:b].tobytes().decode() for a, b in zip(end[:-1], end[1:], strict=True)] == texts


def test_registered_pieces(spark, pieces, sf_docs, rough_docs, no_docs):
    texts = {r.doc_id: r.text for r in sf_docs.select("doc_id", "text").collect()}
    rows = QUERIES["op6_piece_viterbi"](spark, SF).collect()
    assert len(rows) == len(texts) and all(r.round_trip for r in rows)
    for r in rows[:25]:
        ids = plain_viterbi(pieces, texts[r.doc_id][:3000]) if len(texts[r.doc_id]) <= 3000 else None
        assert ids is None or (len(ids), crc(ids)) == (r.n_ids, r.ids_crc32)
        assert r.decoded_crc32 == zlib.crc32(texts[r.doc_id].encode())
    rough = piece_viterbi.op6_piece_viterbi(spark, rough_docs).collect()
    assert len(rough) == len(ROUGH_TEXTS) and all(r.round_trip for r in rough)
    assert piece_viterbi.op6_piece_viterbi(spark, no_docs).count() == 0


# the library's own ids

@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=piece_viterbi.model_path())


def merge_ids(texts):
    merger = piece_viterbi.MergeCoder.load(piece_viterbi.model_path())
    raw, off = spans.text_bytes(pa.array(texts, pa.string()))
    ids, at = merger.encode(raw, off)
    back, end = merger.decode(ids, at)
    assert [back[a:b].tobytes().decode() for a, b in zip(end[:-1], end[1:], strict=True)] == texts
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]


def test_merge_ids_are_the_library_s(library):
    texts = ["", " ", "  two  spaces ", "the committee published its annual report yesterday", "international",
             "Ünï under\tTab\r\n;\r x", "日本語 テスト 😀", "a" * 50, "y" * 3001, "x\x00y", "\n\n lead", "return {\r", " " * 40 + "x"]
    assert merge_ids(texts) == [library.encode(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \t\n'.,aeinorstthe"), st.characters(codec="utf-8", exclude_characters="\u2581")),
                        max_size=40), max_size=6))
def test_any_merge_ids_are_the_library_s(texts):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=piece_viterbi.model_path())
    assert merge_ids(texts) == [library.encode(t) for t in texts]


def test_registered_query_gives_the_library_s_ids(spark, library, sf_docs, rough_docs):
    texts = {r.doc_id: r.text for r in sf_docs.select("doc_id", "text").collect()}
    for r in QUERIES["op6_piece_viterbi"](spark, SF).collect():
        ids = library.encode(texts[r.doc_id])
        assert (r.n_merge_ids, r.merge_ids_crc32, r.merge_round_trip) == (len(ids), crc(ids), True)
    assert all(r.merge_round_trip for r in piece_viterbi.op6_piece_viterbi(spark, rough_docs).collect())
