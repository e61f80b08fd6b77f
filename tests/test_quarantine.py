"""Every vector is accepted or quarantined, in one pass."""

import json

from avspark.session import new_path
from avspark.sources import decode

GOOD = ["a1", "UA1 ", "US", 1, 2, -80.5, 40.25, 900.0, False, 200.0, 90.0, None, None, 1000.0, None, False, 0]


def vector(**slots):
    return [slots.get(f"s{i}", v) for i, v in enumerate(GOOD)]


def response(*vectors):
    return json.dumps({"time": 7, "states": list(vectors)})


ROWS = [
    (1, response(GOOD, vector(s5=None), vector(s6="north"), GOOD[:6], None)), (2, response()), (3, '{"time": 7, "sta'), (4, None), (5, ""),
    (6, json.dumps({"time": 7, "states": None})), (7, response(vector(s9="fast", s13=None))),
]
WANT = {(1, 0): None, (1, 1): "missing_position", (1, 2): "bad_number", (1, 3): "missing_position", (1, 4): "missing_position",
        (2, None): "no_states", (3, None): "bad_response", (4, None): "bad_response", (5, None): "bad_response", (6, None): "bad_response", (7, 0): None}


def test_reasons(spark):
    responses = spark.createDataFrame(ROWS, "poll long, response string")
    found = decode.classified_states(responses).collect()
    assert {(r.poll, r.vector): r.reason for r in found} == WANT and len(found) == len(WANT)
    assert all(r.accepted == (r.reason is None) for r in found)
    assert all((r.raw is None) == (r.accepted or r.poll == 4) for r in found)   # poll 4 has no text


def test_both_outputs_and_replay(spark):
    responses = spark.createDataFrame(ROWS, "poll long, response string")
    path = new_path(spark, "quarantine")
    for _ in range(2):   # the second run replays the first
        decode.write_with_quarantine(responses, path)
    good, bad = decode.read_accepted(spark, path), decode.read_quarantine(spark, path)
    assert sorted(map(tuple, good.drop("vector").collect())) == sorted(map(tuple, decode.decode_states(responses).select(good.drop("vector").columns).collect()))
    assert {(r.poll, r.vector): r.reason for r in bad.collect()} == {k: v for k, v in WANT.items() if v}
    assert "raw" in bad.columns and "longitude" not in bad.columns


def test_no_responses(spark):
    path = new_path(spark, "quarantine")
    decode.write_with_quarantine(spark.createDataFrame([], "poll long, response string"), path)
    assert decode.read_accepted(spark, path).count() == decode.read_quarantine(spark, path).count() == 0


def test_one_scan(spark):
    path = new_path(spark, "landed")
    spark.createDataFrame(ROWS, "poll long, response string").write.parquet(path)
    plan = decode.classified_states(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
