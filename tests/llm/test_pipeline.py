"""The pipeline against a plain version of each stage."""

import __spark_entry__ as entry
import corpus_pipeline as C
from brute import jaccard_classes, without_repeats
from samples import ROUGH_TEXTS, SF, make_docs

from martlens.llm import quality, word_bpe
from martlens.llm.store import Workspace


def plain(spark, docs, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    good = {r.doc_id for r in quality.op5_quality(spark, docs, labels).collect() if r.predicted == 1}
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if r.doc_id in good]
    first = {i for i, (_, c) in jaccard_classes(texts).items() if i == c}
    texts = [(i, t) for i, t in texts if i in first]
    kept = {i: t if len(w) == len(k) else " ".join(k) for (i, t), (_, w, k) in zip(texts, without_repeats(texts), strict=True)}
    bpe = word_bpe.WordBpe.load(word_bpe.vocabulary_path()).tokenizer
    pieces = {}
    for i, t in kept.items():
        n = len(bpe.encode(t or "", add_special_tokens=False).ids) + 1
        pieces[i] = [min(4096, n - lo) for lo in range(0, n, 4096)]
    return good, first, kept, pieces


def test_run_matches_the_plain_version(spark, sf_docs):
    good, first, kept, pieces = plain(spark, sf_docs, SF)
    assert 0 < len(first) < len(good) < sf_docs.count()
    rows = entry.queries()["pipeline"](spark, SF).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        got.setdefault(r.doc_id, []).append(r.length)
    assert got == pieces


def test_stages_keep_the_columns_and_rough_rows(spark, rough_docs):
    assert [n for n, _ in C.STAGES] == ["quality", "near_duplicates", "repeats", "packing"]
    docs = rough_docs
    for name, stage in C.STAGES[1:3]:
        out = stage(spark, docs, SF)
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        docs = out
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert texts[1] is None and 8 not in texts and 9 not in texts and -5 in texts
    assert sorted(r.text or "" for r in docs.collect() if r.doc_id is None) == ["", "no id here"]     # the copy of BASE went
    assert C.STAGES[0][1](spark, rough_docs, SF).columns == rough_docs.columns


def test_text_of_repeated_rows_and_of_copies_without_an_id_survives_once(spark):
    def words(name, n=50):
        return " ".join(f"{name}{i}" for i in range(n))

    texts = [(1, words("a")), (1, words("a")), (1, words("a")),         # repeated row
             (2, words("b")), (None, words("b") + " end"),              # copy without an id
             (None, words("c")), (None, words("c")), (None, "lead " + words("c")),
             (3, words("d")), (3, words("e")), (4, words("d")),         # one id, two texts
             (5, words("f")), (None, None), (6, ""), (6, "")]
    docs = make_docs(spark, texts).repartition(3).cache()
    for name, stage in C.STAGES[1:3]:
        docs = stage(spark, docs, SF)
    rows = [(r.doc_id, r.text, r.n_chars) for r in docs.collect()]
    assert all(n == (None if t is None else len(t)) for _, t, n in rows)
    assert sorted((i, t) for i, t, _ in rows if i is not None) == [
        (1, words("a")), (2, words("b")), (3, words("d")), (3, words("e")), (5, words("f")), (6, ""), (6, "")]
    nameless = sorted((t or "" for i, t, _ in rows if i is None), key=len)
    assert len(nameless) == 2 and nameless[0] == "" and nameless[1] in (words("c"), "lead " + words("c"))


def test_empty_documents(spark, no_docs):
    docs = no_docs
    for _, stage in C.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_entry_lists_the_operators():
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert set(entry.oracle_sql()) <= set(names)


def test_near_duplicates_write_few_tables_where_texts_are_equal_or_unlike(spark, monkeypatch):
    """Plans and jobs of steps that have nothing to do add up in the driver's memory."""
    names, save = [], Workspace.save

    def noted(self, df, name, *a, **b):
        names.append(name)
        return save(self, df, name, *a, **b)

    monkeypatch.setattr(Workspace, "save", noted)
    texts = [(i, " ".join(f"w{i % 5}x{j}" for j in range(30))) for i in range(15)]
    docs = make_docs(spark, texts)
    assert sorted(r.doc_id for r in C.keep_first(spark, docs, SF).collect()) == [0, 1, 2, 3, 4]
    assert len(names) <= 16, names
