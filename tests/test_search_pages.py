"""Term table, page directory and facets against the plain operators."""

import random

import pytest
from conftest import rows

from martlens.operators import search, term_index
from martlens.plans import pages
from martlens.streaming.term_store import TermIndex

NAMES = ["small ring", "Small GEAR", "blue gear", "ring ring small", "蓝 色 ring", "", None, "big red-small_ring", "gear2 small"]
DOCS = [(f"d{i:03d}", f"2024-01-0{i % 3 + 1}", NAMES[i % len(NAMES)]) for i in range(60)]
SCHEMA = "doc_id string, dt string, sku_name string"
KEYWORDS = ["small ring", "blue gear", "ring", "RING small ring", "蓝", "nothing", "?!", "gear2"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA)


def test_division_and_union_equal_matching_texts(spark, docs):
    terms = term_index.term_rows(docs).cache()
    for keyword in KEYWORDS:
        for operator, by_terms in (("and", term_index.having_all), ("or", term_index.having_any)):
            want = rows(search.search(docs, keyword, operator=operator), "doc_id")
            assert rows(by_terms(terms, keyword)) == want, (keyword, operator)


def test_the_stored_index_follows_upserts(spark, docs, tmp_path):
    index = TermIndex(str(tmp_path / "i"), buckets=8, compact_every=2)
    now = {d: (d, dt, n) for d, dt, n in DOCS}
    index.write_batch(docs, 0)
    changes = [[(d, dt, "blue ring") for d, dt, _ in DOCS[:9]] + [("new", "2024-01-02", "small ring")],
               [("d000", "2024-01-01", "small"), ("d001", "2024-01-02", None), (None, "2024-01-01", "ring")]]
    for b, batch in enumerate(changes, 1):
        for _ in range(b):                                  # the second batch is replayed
            index.write_batch(spark.createDataFrame(batch, SCHEMA), b)
        now.update({d: (d, dt, n) for d, dt, n in batch if d is not None})
    table = spark.createDataFrame(list(now.values()), SCHEMA).cache()
    for keyword, operator, date in (("small ring", "and", None), ("blue gear", "or", None), ("ring", "and", "2024-01-02"), (" ", "and", None)):
        want = rows(search.search(table, keyword, date, operator), "doc_id", "dt")
        assert rows(index.search(spark, keyword, operator, date), "doc_id", "dt") == want
    plan = index.search(spark, "small ring")._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


@pytest.mark.parametrize("hot", [False, True])
def test_pages_of_a_stored_result(spark, tmp_path, hot):
    rng = random.Random(1)
    data = [("2024-01-01" if hot and i % 3 else f"2024-01-{rng.randrange(1, 29):02d}", f"d{i:05d}", i) for i in range(2500)]
    hits = spark.createDataFrame(data, "dt string, doc_id string, v int").repartition(5)
    order = ["dt", "doc_id"]
    pages.write_pages(hits, str(tmp_path / "p"), order, 9)
    stored = pages.Pages(spark, str(tmp_path / "p"), order)
    want = sorted(data)
    assert stored.total == 2500 and stored.last_page(40) == 63 and max(r["n"] for r in stored.directory) < 800
    for page_no, size in ((1, 40), (33, 40), (63, 40), (64, 40), (2, 1200), (1, 0)):
        got = [tuple(r) for r in stored.page(page_no, size).select("dt", "doc_id", "v").collect()]
        assert got == want[(page_no - 1) * size:page_no * size]
    cursor, seen = want[99][:2], want[:100]
    for _ in range(3):
        got = [tuple(r) for r in stored.after(cursor, 700).select("dt", "doc_id", "v").collect()]
        seen, cursor = seen + got, got[-1][:2]
    assert seen == want[:2200] and stored.after(want[-1][:2], 10).count() == 0
    assert stored.after(("2000-01-01", ""), 5).first().v == want[0][2]
    plan = stored.page(63, 40)._jdf.queryExecution().executedPlan().toString()
    assert pages.PART in plan.split("PartitionFilters: [")[1].split("]")[0]
    with pytest.raises(ValueError, match="page"):
        stored.page(0, 5)


def test_pages_of_nothing(spark, tmp_path):
    pages.write_pages(spark.createDataFrame([], "dt string, doc_id string"), str(tmp_path / "p"), ["dt", "doc_id"], 4)
    stored = pages.Pages(spark, str(tmp_path / "p"), ["dt", "doc_id"])
    assert (stored.total, stored.last_page(5)) == (0, 1) and stored.page(1, 5).count() == 0


def plain_facets(hits):
    out = [("total", None, search.total(hits).first()[0], None), ("max_age", None, None, search.max_metric(hits, "user_age").first()[0])]
    for col in ("user_age", "user_gender"):
        out += [(col, str(b), n, None) for b, n in rows(search.terms(hits, col))]
    g, a = search.gender_ratio(hits).first(), search.age_ratio(hits).first()
    out += [("gender_ratio", b, None, v) for b, v in zip(("male", "female"), g, strict=True)]
    out += [("age_ratio", b, None, v) for b, v in zip(("lt20", "20to30", "ge30"), a, strict=True)]
    return sorted(out, key=repr)


def test_facets_equal_the_single_answers(spark):
    for data in ([("M", 19), ("F", 20), (None, 31), ("M", None), ("X", 31), ("M", 0)], [], [(None, None)]):
        hits = spark.createDataFrame(data, "user_gender string, user_age int")
        got = [(f, b, n, v if v is None or f != "max_age" else int(v)) for f, b, n, v in rows(search.facets(hits))]
        assert sorted(got, key=repr) == plain_facets(hits)


def test_facets_are_one_shuffle_of_the_hits(spark):
    hits = spark.createDataFrame([("M", 19)] * 50, "user_gender string, user_age int")
    plan = search.facets(hits)._jdf.queryExecution().sparkPlan().toString() + search.facets(hits)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Expand" in plan and "Python" not in plan
