import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from brute import jaccard_classes
from samples import EDGE_TEXTS, ROUGH_TEXTS, make_docs

from martlens.llm import jaccard_join as J
from martlens.llm.components import components
from martlens.llm.store import Workspace


def classes(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_edge_cases_match_all_pairs(spark, edge_docs):
    assert classes(J.near_duplicates(spark, edge_docs)) == jaccard_classes(EDGE_TEXTS)


def test_repeated_rows_and_null_ids(spark, rough_docs):
    out = J.near_duplicates(spark, rough_docs).collect()
    assert len(out) == len(ROUGH_TEXTS)
    expected = jaccard_classes(EDGE_TEXTS)
    assert all((r.n_shingles, r.component_id) == expected[r.doc_id] for r in out if r.doc_id is not None)
    assert sum(r.doc_id is None for r in out) == 3


def test_empty_table(spark, no_docs):
    assert J.near_duplicates(spark, no_docs).columns == ["doc_id", "n_shingles", "component_id"]
    assert J.near_duplicates(spark, no_docs).count() == 0


def test_groups_of_copies_and_chains_match_all_pairs(spark):
    """Many near copies of a few texts, so slices are shared by more than FEW
    sets; edits put pairs on both sides of the bound, and a shared passage
    joins no texts by itself."""
    rng = random.Random(7)
    passage = [f"common{i}" for i in range(25)]
    texts, n = [], 0
    for g in range(6):
        base = [f"g{g}t{i}" for i in range(rng.choice([12, 40, 90]))]
        for _ in range(40):
            w = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 18)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
            if rng.random() < 0.3:
                w += passage
            texts.append((n, " ".join(w)))
            n += 1
    for _ in range(60):
        texts.append((n, " ".join([*passage, *(f"u{rng.randrange(10 ** 6)}" for _ in range(30))])))
        n += 1
    out = classes(J.near_duplicates(spark, make_docs(spark, texts).repartition(5)))
    assert out == jaccard_classes(texts)


def test_heavy_sets_of_unequal_blocks_meet(spark, monkeypatch):
    """Linked sets x and y lie in different blocks.  All slices that they share
    are settled in the block of y, where many sets share them, and none in the
    block of x; y stands for none of them.  The two must find each other by the
    name of a slice."""
    monkeypatch.setattr(J, "FEW", 2)
    words = [f"s3b{i}" for i in range(100)]

    def with_new(lo, n, name):
        return " ".join(f"{name}n{k}" if (k - lo) % 100 < n else w for k, w in enumerate(words))

    x, y = with_new(25, 1, "x"), with_new(75, 1, "y6")
    fillers = [with_new(i, 22, f"f{i}") for i in range(100)]
    texts = list(enumerate([x, y, *fillers, "a b c d e f"]))
    parts = {i: c for i, (_, c) in jaccard_classes(texts).items()}
    assert parts[1] == 0 and len(set(parts.values())) == len(texts) - 1     # the only link
    _, raw, off = next(J.blocks(pa.record_batch({"text": pa.array([x, y], pa.string())})))
    x, y = J.ShingleSets(raw, off).id.tolist()
    blocks = spark.sparkContext.parallelize([texts[:1], texts[1:-1], texts[-1:]], 3).flatMap(list)
    docs = spark.createDataFrame(blocks, "doc_id long, text string")
    found = J.candidate_rows(J.slice_packets(docs, 4), 4).collect()
    assert not any({r.a, r.b} == {x, y} for r in found if r.kind != J.COMMON)
    slices = {b: {r.a for r in found if r.kind == J.COMMON and r.b == b} for b in (x, y)}
    assert slices[x] & slices[y]


def shuffled_rows(df):
    """Rows of each shuffle of a table that was computed."""
    todo, out = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if kind == "ShuffleExchangeExec":
                out.append(node.metrics().apply("shuffleRecordsWritten").value())
            todo.extend(node.children().apply(i) for i in range(node.children().size()))
    return out


@pytest.mark.parametrize("take", ["_shingles", "exploded"])
def test_texts_that_are_not_wanted_are_not_shuffled(spark, take):
    """Where the wanted ids are too many to broadcast, too."""
    texts = [(i * 7919 - 4000, f"one two three four five {i}") for i in range(3000)]
    docs = make_docs(spark, texts).select("doc_id", "text")
    wanted = spark.createDataFrame([(i,) for i, _ in texts[::60]], "doc_id long")
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        out = getattr(J._Verifier(docs, None, Workspace(spark, "t")), take)(wanted)
        got = [r[0] for r in out.collect()]
    finally:
        spark.conf.set(limit, before)
    assert sorted(set(got)) == [i for i, _ in texts[::60]]
    rows = shuffled_rows(out)
    assert rows and max(rows) < 400


@pytest.mark.parametrize("most", [1 << 15, 1 << 16, 1 << 27])
def test_marked_rows_hold_all_wanted_ones(spark, monkeypatch, most):
    """Of more ids than there are cells for, too, and of none."""
    monkeypatch.setattr(J, "MOST_CELLS", most)
    docs = spark.range(-20000, 20000).select(J.F.col("id").alias("doc_id"), J.F.lit("a").alias("text"))
    for step in (3, 401):
        wanted = docs.filter(f"doc_id % {step} = 0").select("doc_id")
        got = J.marked(docs, wanted)
        assert wanted.join(got, "doc_id", "left_anti").count() == 0
        assert got.count() < 40000 and len(got.columns) == 2
    assert J.marked(docs, wanted.limit(0)).count() == 0


def test_registered_query_on_the_table(spark):
    from martlens.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert classes(QUERIES["op1_jaccard_join"](spark, sf)) == jaccard_classes([(r.doc_id, r.text) for r in rows])


def test_sketch_distance_is_a_lower_bound_after_folding():
    rng = np.random.default_rng(1)
    for n, m, shared in ((10, 300, 5), (50, 60, 48), (1, 1, 0), (500, 700, 480)):
        pool = np.unique(rng.integers(0, 1 << 63, n + m, dtype=np.uint64))
        a, b = pool[:n], np.append(pool[:shared], pool[n:n + m - shared])
        apart = len(np.setxor1d(a, b))
        assert J.sketch_distance(J.sketch(a), J.sketch(b)) <= apart


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 7, 10, 40, 100, 333, 5000])
def test_every_link_leaves_agreeing_slices(size):
    """In every band both sets send to, the common leading slices outnumber
    the differences by at least what either set counts on."""
    for other in range(-(-size * 3 // 4), size * 4 // 3 + 1):
        top = max(size, other)
        band = int(np.searchsorted(J.BANDS, top, "right")) - 1
        a, b = (int(J._sent(np.array([x]), np.array([band]))[0]) for x in (size, other))
        agree = min(a, b) - int(J._differences(size, other))
        assert agree >= 1
        assert agree >= int(J._sure(np.array([size]), np.array([band]))[0])


def test_components_match_union_find(spark):
    from brute import union
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(40)]
    links += [(2000, 2001 + i) for i in range(200)]
    nodes = {n for link in links for n in link}
    expected = union(links, nodes)
    df = spark.createDataFrame(links, "a long, b long")
    out = {r.id: r.component for r in components(df, Workspace(spark, "t"), "c").collect()}
    assert all(out.get(n, n) == expected[n] for n in nodes)


def test_components_of_chains_stars_and_cliques_over_many_tasks(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 400)]                                  # a chain
    links += [(1000, i) for i in range(1001, 1300)] + [(i, 999) for i in range(1200, 1210)]
    links += [(a, b) for a in range(2000, 2030) for b in range(2000, 2030)]        # a clique, with loops
    links += [(-7, 5000), (5000, -7), (6000, 6000)] + [(5, None), (None, None)]
    rng.shuffle(links)
    df = spark.createDataFrame(links, "a long, b long").repartition(13)
    out = components(df, Workspace(spark, "t"), "c").collect()
    assert len({r.id for r in out}) == len(out)
    expected = {i: 100 for i in range(100, 401)} | {i: 999 for i in range(999, 1300)} \
        | {i: 2000 for i in range(2000, 2030)} | {-7: -7, 5000: -7}
    assert {r.id: r.component for r in out} == expected


def test_links_added_later_join_components_and_single_documents(spark):
    ws = Workspace(spark, "t")

    def table(*links):
        return spark.createDataFrame(list(links), "a long, b long")

    parts = J._Parts(ws, table((1, 2), (3, 4), (5, 6), (7, 8)))
    before = parts.table
    parts.add(table())
    assert parts.table is before
    parts.add(table((8, 4), (9, 6), (20, 21), (21, 22), (1, 2)))
    assert sorted((r.id, r.component) for r in parts.table.collect()) == [
        (1, 1), (2, 1), (3, 3), (4, 3), (5, 5), (6, 5), (7, 3), (8, 3), (9, 5), (20, 20), (21, 20), (22, 20)]
    parts.add(table((9, 2), (0, 22)))
    assert {r.id: r.component for r in parts.table.collect()} == {
        1: 1, 2: 1, 3: 3, 4: 3, 5: 1, 6: 1, 7: 3, 8: 3, 9: 1, 0: 0, 20: 0, 21: 0, 22: 0}


def test_steps_without_candidates_write_no_tables(spark, monkeypatch):
    """A step that finds nothing to compare or to join ends there."""
    names, save = [], Workspace.save

    def noted(self, df, name, *a, **b):
        names.append(name)
        return save(self, df, name, *a, **b)

    monkeypatch.setattr(Workspace, "save", noted)
    base = [f"t{i}" for i in range(200)]
    docs = make_docs(spark, [(i, " ".join([*base[:-1], f"e{i}"])) for i in range(4)] + [(9, "some other words are in this one")])
    assert {r.doc_id: r.component_id for r in J.near_duplicates(spark, docs).collect()} == {0: 0, 1: 0, 2: 0, 3: 0, 9: 9}
    assert "near-2" in names and {"wanted-2", "shingles-2", "links-2", "parts-2", "heavy-shingles"}.isdisjoint(names), names


class Task:
    """Takes the place of a table and keeps the function given to its tasks."""

    def select(self, *columns):
        return self

    repartitionById = sortWithinPartitions = select

    def mapInArrow(self, run, schema):
        self.run = run
        return self


def bucket_rows(texts, blocks=3):
    """Rows that the one task of one bucket gives, by batch, and the MB that it
    needed beside its packets."""
    sender, taker = J.slice_packets(Task(), 1), J.candidate_rows(Task(), 1)
    packets = []
    for k in range(blocks):
        docs = pa.record_batch({"doc_id": pa.array(range(k, len(texts), blocks), pa.int64()),
                                "text": pa.array(texts[k::blocks], pa.string())})
        packets += [p for b in sender.run(iter([docs])) for p in b.column(1).to_pylist()]
    given = pa.record_batch({"bucket": pa.array([0] * len(packets), pa.int32()), "packet": pa.array(packets, pa.binary())})
    tracemalloc.start()
    try:
        sizes, rows, top = [], [], 0
        for b in taker.run(iter([given])):
            sizes.append(b.num_rows)
            top = max(top, tracemalloc.get_traced_memory()[1])
            rows.append(b)
    finally:
        tracemalloc.stop()
    return sizes, [tuple(r.values()) for b in rows for r in b.to_pylist()], top / 1e6


def test_bucket_is_grouped_in_parts(spark, monkeypatch):
    """A bucket's slices are grouped some at a time, so a task needs little
    memory beside its packets (52 MB where all are grouped at once), hands its
    rows over in pieces, and gives the rows that one part gives."""
    rng = random.Random(4)
    texts = []
    for g in range(40):                             # FEW copies and fewer, more, and texts for themselves
        base = [f"g{g}w{i}" for i in range(300)]
        for _ in range(rng.choice([1, 3, 8, 30])):
            w = list(base)
            w[rng.randrange(300)] = f"e{rng.randrange(10 ** 6)}"
            texts.append(" ".join(w))
    texts += [" ".join(f"t{t}w{i}" for i in range(300)) for t in range(2000)]
    rng.shuffle(texts)
    monkeypatch.setattr(J, "PART_SLICES", 1 << 40, raising=False)
    _, whole, _ = bucket_rows(texts)
    assert {r[4] for r in whole} == {J.STAR, J.RARE, J.COMMON}
    monkeypatch.setattr(J, "PART_SLICES", 1 << 14, raising=False)
    monkeypatch.setattr(J, "PIECE_ROWS", 1000, raising=False)
    sizes, rows, top = bucket_rows(texts)
    assert sorted(rows) == sorted(whole)
    assert max(sizes) <= 1000
    assert top < 20
