"""Log lines keep every byte but those of their own ``ts``."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from martlens.functions.json import without_member
from martlens.sources import logs

GOOD = [
    ('{"type":"startup","mid":"m","mid":"n"}', '{"type":"startup","mid":"m","mid":"n","ts":9}', "n"),
    ('{"n":12345678901234567890123456789012345678901234567890}', '{"n":12345678901234567890123456789012345678901234567890,"ts":9}', None),
    ('{"x":1e400}', '{"x":1e400,"ts":9}', None),
    ("{}", '{"ts":9}', None),
    (' { } \n', ' { "ts":9}', None),
    ('{"ts":5}', '{"ts":9}', None),
    ('{"ts":5,"mid":"a"}', '{"mid":"a","ts":9}', "a"),
    ('{"mid":"a" , "ts" : [1,{"ts":2}] }', '{"mid":"a" ,"ts":9}', "a"),
    ('{"mid":"a", "ts":{"a":"}","b":","}, "ts":null,"z":true}', '{"mid":"a","z":true,"ts":9}', "a"),
    ('{"in":{"ts":1},"l":[{"ts":2},"ts"],"s":"\\"ts\\":3,}"}', '{"in":{"ts":1},"l":[{"ts":2},"ts"],"s":"\\"ts\\":3,}","ts":9}', None),
    ('{"\\u0074s":1,"mid":"é\\n日"}', '{"mid":"é\\n日","ts":9}', "é\n日"),
    ('{"TS":1,"tss":2}', '{"TS":1,"tss":2,"ts":9}', None),
]
BAD = ["", " ", "3", "null", "[1]", "[]", "junk", '{"a":1', '{"a":1} x', '{"a":1}{"b":2}', '{"a":1},{"b":2}', '{"a":1}}', '{"a":1}]',
       '{"a":1}],[{"b":2}', '{"a":1}} {"b":{"c":1}', '{"a":1}, "x":{"b":2}', '{"a":01}', '{"a":tru}', '{"a":1,}', "{a:1}", "{'a':1}",
       '{"a":"x\ny"}', None]


@pytest.fixture(scope="module")
def out(spark):
    lines = [(i, v) for i, v in enumerate([*[g[0] for g in GOOD], *BAD])]
    df = spark.createDataFrame(lines, "k int, value string")
    return {r.k: r for r in logs.ingest(df, F.lit(9)).collect()}


@pytest.mark.parametrize("k", range(len(GOOD)))
def test_objects(out, k):
    r = out[k]
    assert (r.value, r.log.mid, r.log.ts) == (GOOD[k][1], GOOD[k][2], 9) and r.topic != "TOPIC_REJECT"
    if "1e400" not in r.value:
        assert json.loads(r.value)["ts"] == 9


@pytest.mark.parametrize("k", range(len(BAD)))
def test_what_is_no_object(out, k):
    r = out[len(GOOD) + k]
    assert (r.value, r.topic, r.log) == (BAD[k], "TOPIC_REJECT", None)


def test_a_long_line(spark):
    text = '{"ts":1,"a":[' + ",".join(f'{{"ts":{i},"t":"x{i}"}}' for i in range(400)) + ']}'
    df = spark.createDataFrame([(text,)], "v string").select(without_member(F.col("v"), "ts").alias("w"))
    assert rows(df) == [(text.replace('"ts":1,"a"', '"a"', 1),)]
