"""Every registered query equals its DuckDB SQL twin on the sf0.001 tables."""

import pytest

from conftest import SF_SMALL

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry  # noqa: E402
from histmart.plans.registry import all_oracles, all_queries  # noqa: E402
from histmart.sources.raw import DRIVER_TABLES  # noqa: E402
from tools.oracle_check import canon  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_sql():
    assert not set(all_queries()) - set(all_oracles())
    assert set(entry.queries()) >= set(all_queries())


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_parity(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert canon(df.columns, srows) == canon(ocols, res.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "event_type" in df.columns
