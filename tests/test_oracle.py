"""Spark queries against their DuckDB oracles on the smallest scale."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import duck, rows_of  # noqa: E402

from panelkit.plans.oracle_sql import oracle  # noqa: E402
from panelkit.plans.queries import QUERIES as PANEL_QUERIES  # noqa: E402

NAMES = sorted(set(PANEL_QUERIES) & set(oracle()))


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf, con, name):
    sdf = E.queries()[name](spark, sf)
    c1, r1 = rows_of(sdf.columns, [tuple(r) for r in sdf.collect()])
    res = con.execute(E.oracle_sql()[name])
    c2, r2 = rows_of([d[0] for d in res.description], res.fetchall())
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_every_panel_query_has_an_oracle():
    assert set(PANEL_QUERIES) == set(oracle())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 151
