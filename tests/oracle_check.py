"""Runs registered queries next to their SQL on the same parquet and compares values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    key = lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=key)


SPARK_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
               "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
               "date": "DATE", "smallint": "SMALLINT", "tinyint": "TINYINT", "float": "FLOAT"}


def compare(spark, con, sf_dir, name, fn, sql) -> str | None:
    """None when equal, else what differs."""
    df = fn(spark, sf_dir)
    got = df.collect()
    if sql is None:
        return None if got else "no rows"
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    if sorted(cols) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(cols)}"
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    bad = [(c, t, types[c]) for c, t in df.dtypes if SPARK_TYPES.get(t, t) != types[c]]
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    a, b = _rows(df.columns, got), _rows(cols, want)
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    if diff:
        return f"{len(diff)} of {len(a)} rows differ {sorted(cols)}: {diff[:2]}"
    return f"types {bad}" if bad else None


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as e
    from avspark.session import build_session

    sf = "/root/testdata/sf0.01"
    if argv and argv[0].startswith("/"):
        sf = argv.pop(0)
    spark = build_session(master="local[8]", shuffle_partitions=8,
                          extra={"spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    qs, oracle = e.queries(), e.oracle_sql()
    names = [q for q in qs if not argv or any(q.startswith(a) for a in argv)]
    failed = []
    for name in names:
        t = time.time()
        try:
            msg = compare(spark, con, sf, name, qs[name], oracle.get(name))
        except Exception as exc:  # noqa: BLE001
            msg = f"{type(exc).__name__}: {str(exc)[:1500]}"
        mark = "O" if name in oracle else "R"
        print(f"{'ok ' if msg is None else 'BAD'} {mark} {name} {time.time() - t:.1f}s {msg or ''}", flush=True)
        if msg:
            failed.append(name)
    print(f"{len(names) - len(failed)}/{len(names)} ok; failed {failed}")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
