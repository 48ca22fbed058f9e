"""Spark results equal the DuckDB oracle on the smallest fixture."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from churnlens.sources.tables import TABLES
from conftest import SF_SMALL

FAST = [
    "monthly_rollup", "monthly_rollup_shipto", "material_set", "dense_panel", "kalman_level", "gauss_period",
    "forecast_quantiles", "trend_fit", "nba_snapshot", "nba_new_items", "crm_feed", "latest_child",
    "rental_type", "action_labels", "customer_pv",
]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    cols = sdf.columns
    srows = sorted((tuple(_norm(x) for x in r) for r in sdf.collect()), key=repr)
    res = duck.execute(entry.oracle_sql()[name])
    dcols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(dcols)
    idx = [dcols.index(c) for c in cols]
    drows = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert srows == drows
