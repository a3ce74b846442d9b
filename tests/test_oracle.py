"""Registered queries equal their DuckDB oracle (row count, columns, values) on sf0.001."""

import math

import pytest

from roadpulse.registry import oracle_sql, queries
from tests.conftest import SF_SMALL

ORACLE = oracle_sql()
NAMES = sorted(ORACLE)


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return float(v)
    if isinstance(v, (int, float)):
        return "nan" if isinstance(v, float) and math.isnan(v) else round(float(v), 6) + 0.0
    return str(v)


def _rows(records):
    return sorted((tuple(_norm(x) for x in r) for r in records), key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_query_has_an_entry_point():
    assert set(ORACLE) <= set(queries())
    assert len(queries()) >= 100


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, duck, name):
    sdf = queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    got = _rows([tuple(r[c] for c in cols) for r in sdf.collect()])
    rel = duck.sql(ORACLE[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = _rows([tuple(r[i] for i in idx) for r in rel.fetchall()])
    assert len(got) == len(want)
    assert got == want
