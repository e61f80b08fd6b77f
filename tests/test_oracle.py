"""Every registered query against its SQL (or, without SQL, that it returns rows)."""

import pytest

from avspark.plans import catalog
from tests.oracle_check import compare, connect


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf_dir, duck, name):
    assert compare(spark, duck, sf_dir, name, catalog.QUERIES[name], catalog.ORACLE.get(name)) is None


def test_entry_has_stable_schema(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["carrier", "total_flights", "delayed_flights", "on_time_pct",
                          "avg_delay_minutes", "median_delay"]
    assert df.count() == 10
    assert set(entry.oracle_sql()) <= set(entry.queries())
