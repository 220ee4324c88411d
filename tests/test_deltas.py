"""Order totals by deltas equal a full recompute after every batch, in any batch
order, and on a stream."""

import itertools
import json
import os
import random

from conftest import SF_SMALL, rows
from pyspark.sql import functions as F
from test_streaming import NOW, _run

from martlens.functions.time import with_create_date_hour
from martlens.operators import deltas, gmv
from martlens.operators.keyed import last_per_key
from martlens.sources import tables
from martlens.streaming import jobs
from martlens.streaming.sources import text_stream

SCHEMA = "id string, version int, total_amount double, create_time string"
BY = ["create_date", "create_hour"]


def table(spark, versions):
    return with_create_date_hour(spark.createDataFrame(versions, SCHEMA))


def recomputed(versions):
    """Totals from scratch over the latest version of every order."""
    last = {}
    for v in versions:
        if v[0] is not None:
            last[v[0]] = max(last.get(v[0], v), v, key=lambda r: (r[1], (r[2] is not None, r[2] or 0), r[3]))
    sums = {}
    for _, _, amount, time in last.values():
        s = sums.setdefault((time.split(" ")[0], time.split(" ")[1][:2]), [None, 0])
        s[1] += 1
        if amount is not None:
            s[0] = round((s[0] or 0) + amount, 2)
    return sorted(((*k, *v) for k, v in sums.items()), key=repr)


def test_every_prefix_of_any_batch_order(spark):
    batches = [[("a", 1, 10.0, "2024-01-01 10:00:00"), ("b", 1, 5.5, "2024-01-01 10:30:00"), (None, 1, 9.0, "2024-01-01 10:00:00")],
               [("a", 2, 12.0, "2024-01-02 00:00:00"), ("b", 1, 5.5, "2024-01-01 10:30:00"), ("c", 1, None, "2024-01-03 01:00:00")],
               [("b", 3, None, "2024-01-01 11:00:00"), ("b", 2, 7.0, "2024-01-01 10:30:00"), ("c", 1, 1.0, "2024-01-03 01:00:00")]]
    for k, order in enumerate(itertools.permutations(batches)):
        for n in (1, 2, 3) if k == 0 else (3,):
            got = deltas.totals_of_batches([table(spark, b) for b in order[:n]], "id", ["version"], BY)
            assert rows(got) == recomputed([v for b in order[:n] for v in b])


def test_a_replaced_order_leaves_minus_and_plus(spark):
    stored = table(spark, [("a", 1, 10.0, "2024-01-01 10:00:00")])
    batch = table(spark, [("a", 2, 3.0, "2024-01-02 09:00:00"), ("a", 1, 99.0, "2024-01-05 09:00:00"), ("n", 1, 1.0, "2024-01-02 09:00:00")])
    got = rows(deltas.signed_changes(stored, batch, "id", ["version"]), "id", "sign", "total_amount", "create_date")
    assert got == [("a", -1, 10.0, "2024-01-01"), ("a", 1, 3.0, "2024-01-02"), ("n", 1, 1.0, "2024-01-02")]
    stale = table(spark, [("a", 1, 10.0, "2024-01-01 10:00:00")])
    assert deltas.signed_changes(stored, stale, "id", ["version"]).count() == 0
    assert deltas.signed_changes(stored, stale.limit(0), "id", ["version"]).count() == 0


def test_one_order_holds_a_third_of_all_versions(spark):
    rng = random.Random(1)
    versions = [("hot", i, float(i % 50), f"2024-01-{i % 28 + 1:02d} {i % 24:02d}:00:00") for i in range(3000)]
    versions += [(f"o{rng.randrange(900)}", rng.randrange(9), float(rng.randrange(1000)) / 4, f"2024-02-{rng.randrange(1, 29):02d} 05:00:00")
                 for _ in range(6000)]
    rng.shuffle(versions)
    got = deltas.totals_of_batches([table(spark, versions[i::2]).repartition(5) for i in range(2)], "id", ["version"], BY)
    assert rows(got) == recomputed(versions)


def test_only_native_columns(spark):
    b = table(spark, [("a", 1, 10.0, "2024-01-01 10:00:00")])
    plan = deltas.totals_of_batches([b, b], "id", ["version"], BY)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Pandas", "CartesianProduct", "NestedLoop") if x in plan]


def _order(i, amount, created, operated=None):
    return json.dumps({"id": i, "user_id": "7", "total_amount": amount, "create_time": created, "operate_time": operated})


def _batches(tmp_path, files):
    (tmp_path / "in").mkdir()
    for k, lines in enumerate(files):
        f = tmp_path / "in" / f"f{k}.json"
        f.write_text("\n".join(lines) + "\n")
        os.utime(f, (1_700_000_000 + k, 1_700_000_000 + k))     # files are read in this order
    return str(tmp_path / "in")


def test_the_stream_keeps_totals_right_and_survives_replays(spark, tmp_path):
    """Late versions, changed amounts and hours, with compactions in between."""
    files = [[_order("1", 10.0, "2024-01-01 10:00:00"), _order("2", 4.0, "2024-01-01 11:00:00")],
             [_order("1", 12.0, "2024-01-02 08:00:00", "2024-01-02 08:00:00"), "junk", _order(None, 1.0, "2024-01-01 10:00:00")],
             [_order("1", 10.0, "2024-01-01 10:00:00"), _order("3", None, "2024-01-04 09:00:00")],
             [_order("2", 0.5, "2024-01-01 11:00:00", "2024-01-03 00:00:00")], [_order("4", 2.0, "2024-01-02 08:30:00")]]
    source = _batches(tmp_path, files)
    out, totals = str(tmp_path / "o"), str(tmp_path / "t")
    _run(jobs.gmv_job(text_stream(spark, source, 1), out, str(tmp_path / "ck"), NOW, totals=totals, compact_every=2))
    kept = jobs.order_totals(out, totals, 0)
    want = [("2024-01-01", 0.5, 1), ("2024-01-02", 14.0, 2), ("2024-01-04", None, 1)]
    assert rows(kept.daily(spark)) == want
    assert rows(kept.hourly(spark, "2024-01-02")) == [("2024-01-02", "08", 14.0, 2)]
    assert kept.daily(spark, "2024-01-09").count() == 0
    assert rows(gmv.gmv_total(jobs.gmv_store(out).read(spark))) == [r[:2] for r in want]
    # the last batch again, as after a lost commit
    last = spark.createDataFrame([("4", 2.0, "2024-01-02 08:30:00")], "id string, total_amount double, create_time string")
    image = jobs.gmv_store(out).read(spark).limit(0)
    batch = gmv.prepare_orders(image.select(*[F.lit(None).cast(t).alias(c) for c, t in image.dtypes]).unionByName(
        last, allowMissingColumns=True)).select(*image.columns)
    kept.write_batch(batch, 4)
    kept.write_batch(batch, 4)
    assert rows(kept.daily(spark)) == want


def test_one_date_reads_its_folders_only(spark, tmp_path):
    files = [[_order(str(k), 1.0, f"2024-01-{d:02d} 10:00:00") for k, d in enumerate(range(1, 9))]]
    _run(jobs.gmv_job(text_stream(spark, _batches(tmp_path, files), 1), str(tmp_path / "o"), str(tmp_path / "ck"), NOW,
                      totals=str(tmp_path / "t")))
    kept = jobs.order_totals(str(tmp_path / "o"), str(tmp_path / "t"))
    read = kept.hourly(spark, "2024-01-03")
    assert rows(read) == [("2024-01-03", "10", 1.0, 1)]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "create_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_stream_totals_equal_batch_totals_over_the_orders(spark, tmp_path):
    orders = tables.order_info(tables.read_table(spark, SF_SMALL, "orders"))
    lines = [r.value for r in orders.select(F.to_json(F.struct("*")).alias("value")).collect()]
    random.Random(2).shuffle(lines)
    source = _batches(tmp_path, [lines[:500], lines[300:900], lines[900:], lines[:100]])
    _run(jobs.gmv_job(text_stream(spark, source, 1), str(tmp_path / "o"), str(tmp_path / "ck"), NOW, totals=str(tmp_path / "t"),
                      compact_every=2))
    kept = jobs.order_totals(str(tmp_path / "o"), str(tmp_path / "t"))
    got = rows(kept.daily(spark), "create_date", "sum_amount")
    assert got == rows(gmv.gmv_total(gmv.prepare_orders(last_per_key(orders, ["id"], ["create_time"]))))
