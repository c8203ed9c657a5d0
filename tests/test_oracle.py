"""Every registered query against its DuckDB oracle: rows, columns, values.

Runs at sf0.001 by default (BASKETLENS_TEST_SF_DIR=/root/testdata/sf0.01 for
the driver's scale)."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from basketlens.plans import catalog

SF_DIR = os.environ.get("BASKETLENS_TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["customer", "part", "orders", "lineitem", "events"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df: pd.DataFrame):
    cols = sorted(df.columns)
    return cols, sorted(repr(tuple(_norm(x) for x in r))
                        for r in df[cols].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    yield c
    c.close()


def test_every_query_has_an_oracle():
    missing = set(catalog.queries()) - set(entry.oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("key", sorted(catalog.queries()))
def test_matches_oracle(spark, con, key):
    got = catalog.queries()[key](spark, SF_DIR).toPandas()
    want = con.sql(entry.oracle_sql()[key]).df()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "estimated_annual_value" in df.columns
