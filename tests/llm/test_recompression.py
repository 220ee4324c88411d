import random

import numpy as np
from brute import sha, without_repeats
from samples import EDGE_TEXTS, ROUGH_TEXTS, SF, make_docs

from martlens.llm import recompression as R
from martlens.llm.queries import QUERIES


def expected(texts, width=35):
    return sorted((i, len(w), len(w) - len(k), sha(k)) for i, w, k in without_repeats(texts, width))


def got(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect())


def test_edge_cases(spark, edge_docs):
    assert got(R.op7_recompression(spark, edge_docs)) == expected(EDGE_TEXTS)


def test_repeated_rows_and_null_ids(spark, rough_docs):
    def key(rows):
        return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))
    texts = ROUGH_TEXTS
    rows = [tuple(r) for r in R.op7_recompression(spark, rough_docs).collect()]
    assert key(rows) == key([(i, len(w), len(w) - len(k), sha(k)) for i, w, k in without_repeats(texts)])


def test_empty_table(spark, no_docs):
    assert R.op7_recompression(spark, no_docs).count() == 0
    assert R.remove_repeats(spark, no_docs).columns == no_docs.columns


def test_passages_at_many_places(spark):
    """Shared passages of lengths around a window, at the start, inside and at
    the end of texts; runs of one word; copies in one text."""
    rng = random.Random(11)
    passages = [[f"p{k}x{i}" if k % 3 else rng.choice(["to", "be", "or"]) for i in range(n)]
                for k, n in enumerate([34, 35, 36, 50, 80, 35, 40, 200])]
    texts = []
    for n in range(120):
        w = [f"u{rng.randrange(300)}" for _ in range(rng.randint(0, 90))]
        for _ in range(rng.randint(0, 3)):
            at = rng.choice([0, len(w), rng.randint(0, len(w))])
            w[at:at] = rng.choice(passages)
        if rng.random() < 0.2:
            w += ["run"] * rng.randint(30, 90)
        texts.append((n, " ".join(w)))
    assert got(R.op7_recompression(spark, make_docs(spark, texts).repartition(4))) == expected(texts)


def test_registered_query(spark, sf_docs):
    texts = [(r.doc_id, r.text) for r in sf_docs.select("doc_id", "text").collect()]
    assert got(QUERIES["op7_recompression"](spark, SF)) == expected(texts)


def test_remove_repeats_keeps_other_columns_and_clean_texts(spark, rough_docs):
    out = R.remove_repeats(spark, rough_docs)
    assert out.schema.simpleString() == rough_docs.schema.simpleString()
    rows = {r.doc_id: r for r in out.collect() if r.doc_id is not None}
    assert rows[1].text is None and rows[7].text == "a b  c\td" and rows[8].text == "" and rows[8].n_chars == 0
    assert rows[14].lang == "en" and rows[14].owner == 2


def test_symbols_depend_on_their_context_only():
    rng = np.random.default_rng(5)
    core = rng.integers(0, 40, 60, dtype=np.int64).astype(np.uint64)
    seen = []
    for n in (0, 17, 61):
        words = np.concatenate([rng.integers(0, 40, n).astype(np.uint64), core, rng.integers(0, 40, 30).astype(np.uint64)])
        at = np.arange(len(words))
        s = R.Symbols(words, at, at, at + 1, np.append(True, np.zeros(len(words) - 1, bool)))
        s = R.name_runs(s, len(words))
        for turn in range(R.ROUNDS):
            s = R.name_pairs(s, len(words), turn)
        inside = (s.lo >= n) & (s.hi <= n + 60)
        seen.append({(int(a) - n, int(b) - n, int(x)) for a, b, x in zip(s.lo[inside], s.hi[inside], s.name[inside], strict=True)})
    assert seen[0] == seen[1] == seen[2] and seen[0]
