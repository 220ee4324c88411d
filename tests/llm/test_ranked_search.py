import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from samples import EDGE_TEXTS, ROUGH_TEXTS, SF, make_docs

from martlens.llm import ranked_search as R
from martlens.llm import spans
from martlens.llm.queries import ORACLE_SQL, QUERIES
from martlens.llm.store import Workspace

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def expected(docs, items, k=20):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, length = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        asked = terms(text)
        found = []
        for i, c, n in counted:
            m = 75 + 25 * n * n_docs // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in asked if c[t])
            if score > 0:
                found.append((-score, i is None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(found)[:k], 1)]
    return out


def by_place(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0, r[3]))


def items_table(spark, items):
    return spark.createDataFrame([(i, t, 1, 2, 3, "x", 5) for i, t in items],
                                 "item_id long, text string, number int, rank int, shard int, term string, doc_id int")


ITEMS = [(1, "the end"), (2, "a b c D the the W3 w5 w6"), (3, None), (4, "?? --"), (5, "日本語 É é word▁"), (6, "the " * 50),
         (7, "p q one one ONE no id here"), (2, "w7 w7"), (None, "b")]


@pytest.mark.parametrize("texts", [EDGE_TEXTS, ROUGH_TEXTS])
def test_edge_cases(spark, texts):
    got = R.search(spark, make_docs(spark, texts).repartition(3), items_table(spark, ITEMS), k=4, shard_bytes=30_000)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert by_place(got.collect()) == by_place(expected(texts, ITEMS, 4))


def test_empty_tables(spark, no_docs, edge_docs):
    assert R.op12_ranked_search(spark, no_docs, items_table(spark, ITEMS)).count() == 0
    assert R.op12_ranked_search(spark, edge_docs, items_table(spark, [])).count() == 0
    assert R.op12_ranked_search(spark, edge_docs, items_table(spark, [(1, "!"), (2, None)])).count() == 0


def random_texts(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    return [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([0, 1, 5, 40, 40, 300])))) for i in range(n)]


def test_many_blocks_windows_and_ties(spark, monkeypatch):
    """Lists of many blocks, copies with equal scores at the border of the heap."""
    texts = random_texts(5, 1500)
    texts += [(5000 + i, texts[3][1]) for i in range(40)] + [(None, t) for _, t in texts[:200]]
    items = [(i, t) for i, t in random_texts(6, 25)] + [(100, texts[3][1]), (101, "t0 t1 t2"), (102, "t299 t0")]
    docs = make_docs(spark, texts).repartition(2)
    got = by_place(R.search(spark, docs, items_table(spark, items)).collect())
    assert got == by_place(expected(texts, items))


def test_all_terms_and_query_blocks_give_the_same(spark, monkeypatch):
    texts, items = random_texts(7, 300), random_texts(8, 20)
    monkeypatch.setattr(R, "VOCABULARY_BYTES", -1)
    monkeypatch.setattr(R, "QUERY_BYTES", 2000)
    got = R.search(spark, make_docs(spark, texts), items_table(spark, items), k=7)
    assert by_place(got.collect()) == by_place(expected(texts, items, 7))


def test_a_stored_index_answers_again(spark):
    texts = random_texts(9, 200)
    ws = Workspace(spark, "t")
    index = ws.save(R.build_index(make_docs(spark, texts), shard_bytes=20_000), "index")
    assert index.filter("term IS NULL").count() > 1
    for items in (random_texts(10, 5), random_texts(11, 5)):
        queries = spark.createDataFrame(items, "number long, text string")
        got = [(r.number, r.rank, r.doc_id, r.score) for r in
               R.search_index(spark, index, queries, Workspace(spark, "t"), 5).collect()]
        assert by_place(got) == by_place(expected(texts, items, 5))


def shard_of(texts):
    shard = R._Shard(7)
    for rows, raw, off in spans.blocks(pa.record_batch({"doc_id": pa.array([i for i, _ in texts], pa.int64()),
                                                        "text": pa.array([t for _, t in texts], pa.string())})):
        shard.add(rows.column(0), raw, off, None)
    first, *rest = (r for b in shard.rows() for r in b.to_pylist())
    return first, {r["term"]: (r["n"], r["directory"], r["postings"]) for r in rest}


def test_blocks_of_non_essential_lists_stay_packed():
    """One rare term decides: of the frequent list only the rare one's blocks are unpacked."""
    texts = [(i, f"often r{i} " + ("rare " * 3 if i % 900 == 5 else "")) for i in range(9000)]
    first, lists = shard_of(texts)
    reader = R._Reader(first["directory"], lists, lambda n: R.length_weights(n, 9000, 30000))
    often, rare = (x[0] for x in R._terms(["often", "rare"]))
    heap = R.Heap(2)
    asked = R.search_shard(reader, [(often, 3), (rare, 5000)], heap)
    assert heap.ids.tolist() == [5, 905] and len(reader.list(often).last) == 71
    # all of them up to the second find (document 1920), then the blocks that hold a candidate
    assert len(reader.list(often).blocks) <= 15 + 8 and asked < 40


def test_block_maxima_are_bounds():
    texts = random_texts(12, 700)
    first, lists = shard_of(texts)
    reader = R._Reader(first["directory"], lists, lambda n: R.length_weights(n, 700, 40000))
    tight = 0
    for term in lists:
        x = reader.list(term)
        for b in range(len(x.last)):
            document, gain = x.unpack(b, reader.weights)
            assert (np.diff(document) > 0).all() and document[-1] == x.last[b] and gain.max() <= x.most[b] <= x.top
            tight += gain.max() == x.most[b]
    assert tight > 0
    wide = R._Shard(1)
    wide.add(pa.array([1, 2], pa.int64()), *spans.text_bytes(pa.array(["x " * 70000 + "y", "x " * 300])), None)
    rows = [r for b in wide.rows() for r in b.to_pylist()]
    reader = R._Reader(rows[0]["directory"], {r["term"]: (r["n"], r["directory"], r["postings"]) for r in rows[1:]},
                       lambda n: R.length_weights(n, 2, 70301))
    x = reader.list(R._terms(["x"])[0][0])
    assert x.unpack(0, reader.weights)[1].tolist() == R.impact(np.array([70000, 300]), reader.weights).tolist()


def test_long_documents_do_not_overflow():
    n = np.array([1, 10 ** 7], np.uint32)
    assert R.length_weights(n, 5 * 10 ** 10, 10 ** 13).tolist() == [75, 75 + 25 * 10 ** 7 * 5 * 10 ** 10 // 10 ** 13]


def test_registered_query_against_sql_and_brute_force(spark, sf_docs):
    got = by_place(QUERIES["op12_ranked_search"](spark, SF).collect())
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert got == by_place(con.execute(ORACLE_SQL["op12_ranked_search"]).fetchall())
    texts = [(r.doc_id, r.text) for r in sf_docs.select("doc_id", "text").collect()]
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    assert got == by_place(expected(texts, items))
