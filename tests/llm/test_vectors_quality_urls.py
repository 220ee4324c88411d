import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from brute import union
from samples import SF, SF_TRAIN, make_docs
from oracle_compare import compare, duck

from martlens.llm import quality, spans, url_filter
from martlens.llm import quantised_neighbours as N
from martlens.llm.queries import ORACLE_SQL, QUERIES

# vectors


def all_pairs(rows, least=0.9):
    good = {}
    for k, (i, v) in enumerate(rows):
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            a = np.array(v, float) / max(map(abs, v))
            good[k] = (i, a / np.sqrt(a @ a))
    links = {k: 0 for k in good}
    pairs = []
    for k, (i, a) in good.items():
        for m, (j, b) in good.items():
            if k != m and len(a) == len(b) and a @ b >= least:
                links[k] += 1
                pairs.append((i, j))
    parts = union(pairs, {i for i, _ in good.values()})
    return sorted(((i, links.get(k, 0), parts[i] if k in good else i) for k, (i, _) in enumerate(rows)), key=str)


def got(df):
    rows = df.collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in rows), key=str)


def clustered(d, groups, each, near, seed):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(groups):
        centre = rng.standard_normal(d)
        out += [centre + near * np.linalg.norm(centre) / np.sqrt(d) * rng.standard_normal(d) for _ in range(each)]
    return out


def test_clusters_copies_and_odd_vectors(spark):
    vectors = [v.tolist() for v in clustered(32, 30, 6, 0.12, 1) + clustered(32, 200, 1, 0, 2)]
    vectors += [vectors[0]] * 70 + [[2 * x for x in vectors[3]], None, [], [0.0] * 32, [float("nan")] + [1.0] * 31,
                                   [float("inf")] * 32, [None] + [1.0] * 31, [1e300] * 32, [1e-300] * 32, [1.0, 2.0], [2.0, 4.1]]
    rows = [*enumerate(vectors), (None, vectors[0])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, id int, tile int")
    out = got(N.near_vectors(spark, df.repartition(4)))
    want = all_pairs(rows)
    assert sum(n for _, n, _ in out) >= 0.97 * sum(n for _, n, _ in want)
    assert [x for x in out if x[0] is None or x[0] >= 450] == [x for x in want if x[0] is None or x[0] >= 450]
    exact = dict((i, n) for i, n, _ in want)
    assert all(n <= exact[i] for i, n, _ in out)


def test_pairs_at_the_bound_are_found(spark):
    """Pairs with a cosine just above 0.9, the hardest to find."""
    rng = np.random.default_rng(9)
    rows = []
    for k in range(300):
        a, b = rng.standard_normal((2, 64))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        rows += [(2 * k, a.tolist()), (2 * k + 1, (0.905 * a + np.sqrt(1 - 0.905 ** 2) * b).tolist())]
    df = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<float>")
    out = got(N.near_vectors(spark, df))
    assert sum(n for _, n, _ in out) >= 0.93 * 600


def test_large_groups_are_tiled(spark, monkeypatch):
    monkeypatch.setattr(N, "CHUNK", 20)
    rows = list(enumerate(v.tolist() for v in clustered(16, 2, 75, 0.02, 4)))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(N.near_vectors(spark, df)) == all_pairs(rows)


def test_registered_vectors_recall(spark):
    df = spark.read.parquet(f"{SF_TRAIN}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    out, want = got(QUERIES["op4_quantised_neighbours"](spark, SF_TRAIN)), all_pairs(rows)
    assert sum(n for _, n, _ in out) >= 0.9 * sum(n for _, n, _ in want)
    assert len(out) == len(rows)


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert N.near_vectors(spark, df).count() == 0


# quality

def remainder(i):
    return zlib.crc32(str(i).encode()) % 3


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_TRAIN}/labels.parquet").collect()}
    rows = QUERIES["op5_quality"](spark, SF_TRAIN).collect()
    assert all(r.held_out == (remainder(r.doc_id) == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    out = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in out) >= 0.95 * len(out)


def test_held_out_labels_and_other_columns_are_not_read(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    from pyspark.sql import functions as F
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumn("source", F.lit("x")).withColumn("lang", F.lit("y")).repartition(5)
    a = {r.doc_id: r.score for r in quality.op5_quality(spark, docs, labels).collect()}
    b = {r.doc_id: r.score for r in quality.op5_quality(spark, other, flipped).collect()}
    assert a.keys() == b.keys() and max(abs(a[i] - b[i]) for i in a) < 1e-6


def test_quality_edge_cases(spark, rough_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.op5_quality(spark, rough_docs, none).collect()} == {0.5}
    some = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 22)] + [(3, None, 0), (None, 1, 0), (4, 1, 1)],
                                 "doc_id long, quality int, toxic int")
    rows = quality.op5_quality(spark, rough_docs, some).collect()
    assert len(rows) == rough_docs.count() and all(0 <= r.score <= 1 for r in rows)
    one = spark.createDataFrame([(i, 1, 0) for i in range(1, 22)], "doc_id long, quality int, toxic int")
    assert all(0.5 < r.score < 1 for r in quality.op5_quality(spark, rough_docs, one).collect())
    assert quality.op5_quality(spark, no_docs, some).count() == 0


def test_pooling_against_plain_loops(monkeypatch):
    """Texts above and below every block size, with empty ones between."""
    rng = np.random.default_rng(4)
    texts = ["", "one", "A a a!", None, " ".join(f"w{i % 40}" for i in range(700)), " ".join(f"V{i}" for i in range(300)), ""]
    vectors = rng.standard_normal((quality.SLOTS, quality.DIMS)).astype(np.float32)
    monkeypatch.setattr(quality, "STEP", 100)
    monkeypatch.setattr(quality, "TEXTS", 3)
    raw, off = spans.text_bytes(pa.array(texts))
    got = quality.pooled(raw, off, vectors)
    for i, t in enumerate(texts):
        own = np.frombuffer((t or "").encode(), np.uint8)
        words, shapes, _ = quality.token_slots(own, np.array([0, len(own)]))
        want = []
        for tokens in (words, shapes):
            v = [[float(x) for x in vectors[k]] for k in tokens]
            mean = [sum(c) / max(1, len(v)) for c in zip(*v, strict=True)] if v else [0.0] * quality.DIMS
            square = [sum(x * x for x in c) / len(v) for c in zip(*v, strict=True)] if v else [0.0] * quality.DIMS
            want += [*mean, *[max(q - m * m, 0) ** 0.5 for q, m in zip(square, mean, strict=True)]]
        assert np.allclose(got[i], want, atol=2e-3)


def test_network_against_plain_loops():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((300, 6))
    y = (x[:, 0] + 0.3 * rng.standard_normal(300) > 0).astype(int)
    net = quality.Network(x, y)
    w1, b1, w2, b2 = net.p
    for row in x[:20]:
        z = [(a - m) / s for a, m, s in zip(row, net.mean, net.scale, strict=True)]
        hidden = [max(0.0, sum(z[i] * w1[i, j] for i in range(6)) + b1[j]) for j in range(quality.HIDDEN)]
        logit = sum(h * w for h, w in zip(hidden, w2[:, 0], strict=True)) + b2[0]
        assert abs(net.score(row[None])[0] - 1 / (1 + np.exp(-logit / net.temperature))) < 1e-9
    assert ((net.score(x) >= 0.5) == y).mean() > 0.9
    # the temperature: none apart leaves 1, many outvote the prior
    assert abs(np.log(quality.Network._calibrate(np.zeros(0), np.zeros(0)))) < 0.03
    logit = rng.standard_normal(4000) * 6
    truth = (rng.random(4000) < 1 / (1 + np.exp(-logit / 3))).astype(float)
    assert 2.5 < quality.Network._calibrate(logit, truth) < 3.5


def test_neighbourhoods_add_up_beyond_sixteen_bits():
    words = np.zeros(quality.LIFTED * 3 + 5, np.int64) + 4000
    sums, counts = np.zeros((quality.SLOTS, quality.DIMS), np.int64), np.zeros(quality.SLOTS, np.int64)
    heard = np.full((len(words), quality.DIMS), -quality.LIFT, np.int8)
    heard[:, 1] = quality.LIFT
    quality.add_by_slot(sums, counts, words, heard)
    assert counts[4000] == len(words) == counts.sum()
    assert sums[4000, 0] == -quality.LIFT * len(words) and sums[4000, 1] == quality.LIFT * len(words)


def test_context_sums_match_a_plain_count(spark):
    texts = [(1, "a b a c. C!! c. c."), (2, "b a"), (3, None), (4, "solo")]
    table = {}
    for part, raw in quality.context_sums(make_docs(spark, texts).repartition(3)).collect():
        rows = quality._large(bytes(raw)).reshape(quality.GROUP, quality.DIMS + 1)
        table.update({part * quality.GROUP + k: r for k, r in enumerate(rows) if r.any()})
    places, signs = quality.index_places()
    want = {}
    for _, t in texts:
        raw = np.frombuffer((t or "").encode(), np.uint8)
        words, shapes, _ = quality.token_slots(raw, np.array([0, len(raw)]))
        for i in range(len(words)):
            for x in (words[i], shapes[i]):
                row = want.setdefault(int(x), np.zeros(quality.DIMS + 1, np.int64))
                row[-1] += 1
                for j in range(max(0, i - 2), min(len(words), i + 3)):
                    for y in (words[j], shapes[j]):
                        if j != i:
                            row[places[y]] += signs[y]
    assert table.keys() == want.keys() and all((table[k] == want[k]).all() for k in want)


# urls

URLS = [None, "", "no scheme", "http://A.Com/x", "https://example.com/en/1?q#f", "https://WWW.example.com/en/", "ftp://a.net/es/x",
        "http://net/fr/", "http://a.net.org/fr/", "http://xcom/", "http://com", "http://com/", "http://com?x=/", "http://a.com#/en/",
        "a://b://c.com/x", "http://b.org/x.com/", "http://ex.com:80/", "http://é.com/ä\n?z", "http://" + "a" * 5000 + ".com/" + "b" * 9000,
        "http://x.example.com/en/", "http://example.com/en", "http://a.example.net/es/1", "http://a.example.net/fr/\n2?x", "://.com/"]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(k, u, "<p>", "r") for k, u in enumerate(URLS)] + [(3, URLS[3], "<p>", "r"), (None, URLS[4], "", "")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, rule string")


def judged(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), -k, h + p, v) for k, (v, h, p) in enumerate(rules)
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, _, rule, verdict = max(fits, default=(0, 0, None, "allow"))
    return host, path, rule, verdict


def test_urls_match_plain_rules(spark, pages):
    many = [("block" if k % 2 else "allow", f"h{k}.com", f"/p{k}/") for k in range(40)]     # several words of bits
    extra = spark.createDataFrame([(1000 + k, f"http://www.h{k % 45}.com/p{k % 41}/x") for k in range(200)], "page_id long, url string")
    for rules, table in ((url_filter.RULES, pages), ([*url_filter.RULES, *many], extra)):
        for r, p in zip(url_filter.judge(table, rules).orderBy("page_id", "host").collect(),
                        table.withColumn("h", url_filter.host_of(table.url)).orderBy("page_id", "h").collect(), strict=True):
            assert (r.host, r.path, r.rule, r.verdict) == judged(p.url, rules)
    assert url_filter.judge(pages.limit(0)).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, []).collect()} == {"allow"}


def test_globs_decide_where_no_rule_fits(spark, pages):
    out = {r.page_id: r for r in url_filter.judge(pages, [], [("block", "*.net/*"), ("block", "*/x.c?m/")]).collect()}
    assert [k for k, r in out.items() if r.verdict == "block"] == [6, 7, 15, 21, 22] and out[6].rule is None


@pytest.mark.parametrize("glob", ["abc", "*b*", "a?c", "+.c/*", "a*c*e", "**", "?", "+"])
def test_automaton_matches_regular_expressions(glob):
    pattern = re.compile("".join({"*": ".*", "+": "[^/]*", "?": "."}.get(c, re.escape(c)) for c in glob), re.S)
    texts = ["", "a", "abc", "abcd", "a.c/x", "x/a.c/", ".c/", "axc", "aXcYe", "ab", "b", "a\nc", "/"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.append(0, np.cumsum([len(t) for t in texts]))
    filler = ["zz" * 40] * 3        # pushes the glob over a word boundary
    fits = url_filter.ShiftAnd([*filler, glob]).match(raw, off)[:, -1]
    assert fits.tolist() == [bool(pattern.fullmatch(t)) for t in texts]


def test_registered_urls_match_sql(spark):
    problems, n = compare(QUERIES["op10_url_filter"](spark, SF_TRAIN), duck(SF_TRAIN), ORACLE_SQL["op10_url_filter"])
    assert not problems and n == 250
