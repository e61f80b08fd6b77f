"""Flights: how the lookups are joined, on rows with missing, null and repeated keys."""

import datetime

import pytest

from avspark import dims, schemas
from avspark.plans import catalog
from avspark.plans import flights as plans
from avspark.sources import bindings

_DAY = datetime.datetime(1995, 2, 3)
_ROWS = {
    "supplier": [{"s_suppkey": 1, "s_nationkey": 2}],
    "customer": [{"c_custkey": 5, "c_nationkey": 3}, {"c_custkey": 6, "c_nationkey": 2}, {"c_custkey": 6, "c_nationkey": 4}, {"c_custkey": None, "c_nationkey": 9}],
    "orders": [{"o_orderkey": k, "o_custkey": c, "o_orderdate": _DAY} for k, c in ((10, 5), (11, 6), (12, 99), (13, None), (None, 5))],
    "lineitem": [{"l_orderkey": k, "l_linenumber": 1, "l_partkey": 7, "l_suppkey": 1, "l_extendedprice": 10.0, "l_returnflag": "R", "l_shipdate": _DAY}
                 for k in (10, 11, 12, 13, 14, None)],
}


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    for name, rows in _ROWS.items():
        empty = spark.createDataFrame([], schemas.TABLES[name])
        rows = [tuple(r.get(c) for c in empty.columns) for r in rows]
        spark.createDataFrame(rows, empty.schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_lookups_keep_every_line_item(spark, made):
    found = bindings.ops_flights(spark, made, "flight_id", "origin", "destination", "month").collect()
    rows = [(r["flight_id"].split("-")[0] if r["flight_id"].count("-") == 5 else "none", r) for r in found]
    months = sorted((order, r["month"] is not None) for order, r in rows)
    assert months == [("10", True), ("11", True), ("11", True), ("12", True), ("13", True), ("14", False), ("none", False)]
    assert sorted(r["destination"] for order, r in rows if order in ("10", "11")) == sorted(dims.NETWORK_CODES[n] for n in (3, (2 + 1 + 7) % 25, 4))


def test_line_items_do_not_move_to_the_customers(spark, made):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = bindings.ops_flights(spark, made, "flight_id", "destination")._jdf.queryExecution().optimizedPlan()
        text = plan.toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    joins = [line for line in text.splitlines() if "Join LeftOuter" in line]
    depth = {key: next(line for line in joins if key in line).index("Join") for key in ("o_custkey", "l_orderkey")}
    assert depth["o_custkey"] > depth["l_orderkey"]


def test_loads_read_derived_flights(spark, made, monkeypatch):
    read = []
    load = plans.files.append_missing
    monkeypatch.setattr(plans.files, "append_missing", lambda source, *more: (read.extend(source.inputFiles()), load(source, *more)))
    assert catalog.QUERIES["s5_j9_load_missing"](spark, made).count() == 6
    assert read and not [f for f in read if "lineitem" in f]
