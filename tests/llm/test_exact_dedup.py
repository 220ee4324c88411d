import hashlib
from collections import Counter

from samples import ROUGH_TEXTS, SF, make_docs

from martlens.llm import exact_dedup as E
from martlens.llm.queries import ORACLE_SQL, QUERIES
from martlens.llm.store import Workspace

LOWER = str.maketrans(E.UPPER, E.UPPER.lower())


def expected(texts):
    """Multiset of result rows; exactly one row of a group stays."""
    groups = {}
    for i, t in texts:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    out = Counter()
    for t, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i or 0), reverse=True)
        for n, i in enumerate(ids):
            out[i, ids[0], len(ids), n == 0, hashlib.sha256(t.encode()).hexdigest()] += 1
    return out


def got(df):
    return Counter(tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())


CASES = [(100, "Straße ÀÉ K"), (101, "straße ÀÉ k"), (102, "STRAßE àé K"), (103, "K"), (104, "K"), (105, "k"),
         (106, "İ"), (107, "i̇"), (108, "a "), (109, "a"), (None, "A")]


def test_edge_cases(spark, rough_docs, no_docs):
    assert got(E.op13_exact_dedup(spark, rough_docs)) == expected(ROUGH_TEXTS)
    assert got(E.op13_exact_dedup(spark, make_docs(spark, CASES))) == expected(CASES)
    assert E.op13_exact_dedup(spark, no_docs).count() == 0 and E.without_copies(spark, no_docs).count() == 0


def test_hot_groups(spark):
    """A third of the rows are one text, another third have no id."""
    texts = [(i, "Hot" if i % 2 else "hOT") for i in range(2000)] + [(None, f"n{i % 700}") for i in range(2000)] \
        + [(i, f"t{i % 1500}") for i in range(2000)]
    docs = make_docs(spark, texts).repartition(7)
    assert got(E.op13_exact_dedup(spark, docs)) == expected(texts)
    kept = E.without_copies(spark, docs)
    assert kept.columns == docs.columns
    want = [i for (i, _, _, stays, _), n in expected(texts).items() if stays for _ in range(n)]
    assert Counter(r.doc_id for r in kept.collect()) == Counter(want)


def test_light_and_heavy_agree(spark):
    """Whatever the sketch calls frequent, the answer is the same."""
    texts = [(i, f"t{(i * i) % 97}") for i in range(3000)]
    ws = Workspace(spark, "t")
    table = ws.save(E.digests(make_docs(spark, texts).repartition(5)), "digests")
    for tracked, share in ((16, 4), (64, 10), (1024, 200)):
        heavy = E.winners(table, E.frequent(table, 3000, tracked, share))
        sizes = {bytes(r.digest): r["size"] for r in heavy.collect()}
        assert len(sizes) <= E.most_winners(tracked, share)
        rows = E.decide(table, heavy).withColumn("text_sha256", E.F.lower(E.F.hex("digest")))
        assert got(rows) == expected(texts)
        for t in {t for _, t in texts}:
            n, d = sum(x == t for _, x in texts), hashlib.sha256(t.encode()).digest()
            assert sizes.get(d, n) == n and (d in sizes or n < 3000 / share)


def test_registered_query_against_sql(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = Counter(con.execute(ORACLE_SQL["op13_exact_dedup"]).fetchall())
    assert got(QUERIES["op13_exact_dedup"](spark, SF)) == want


def test_no_python_in_the_plan(spark, rough_docs):
    plan = E.op13_exact_dedup(spark, rough_docs)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Pandas", "Arrow", "Cartesian") if x in plan]
