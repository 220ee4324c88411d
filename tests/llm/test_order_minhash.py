import hashlib

from brute import likeness, order_minhash
from samples import EDGE_TEXTS, ROUGH_TEXTS, SF

from martlens.llm import order_minhash as O
from martlens.llm.queries import QUERIES


def as_hex(prints):
    return "".join(f"{x:08x}" for x in prints)


def expected(texts):
    rows = sorted(texts)
    out = {}
    for k, (i, t) in enumerate(rows):
        t, following = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + following[:half]
        own, changed = order_minhash(t), order_minhash(edited)
        out[i] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), as_hex(own), as_hex(changed),
                  likeness(own, changed), likeness(own, order_minhash(following)))
    return out


def got(df):
    return {r.doc_id: tuple(r)[1:] for r in df.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect()}


def test_edge_cases_match_the_definition(spark, edge_docs):
    assert got(O.op2_order_minhash(spark, edge_docs)) == expected(EDGE_TEXTS)


def test_registered_query(spark, sf_docs):
    texts = [(r.doc_id, r.text) for r in sf_docs.select("doc_id", "text").collect()]
    assert got(QUERIES["op2_order_minhash"](spark, SF)) == expected(texts)


def test_repeated_rows_and_null_ids(spark, rough_docs):
    out = O.op2_order_minhash(spark, rough_docs).collect()
    assert len(out) == len(ROUGH_TEXTS)
    assert all(r.near_next is None for r in out if r.doc_id is None)
    assert len({r.fingerprint for r in out if r.doc_id == 8}) == 1


def test_empty_table_and_single_row(spark, no_docs, edge_docs):
    assert O.op2_order_minhash(spark, no_docs).count() == 0
    one = O.op2_order_minhash(spark, edge_docs.filter("doc_id = 8")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_successors_over_gaps(spark):
    ids = [-(1 << 62), -4097, -1, 0, 1, 4095, 4096, 10 ** 6, 10 ** 12, (1 << 62) + 5]
    df = spark.createDataFrame([(i,) for i in ids + ids[:3]] + [(None,)], "id long")
    out = {r.id: r.next_id for r in O.successors(df).collect()}
    assert out == dict(zip(ids, ids[1:] + ids[:1], strict=True))


def test_no_python_in_the_plan(spark, edge_docs):
    plan = O.op2_order_minhash(spark, edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop") if x in plan]
