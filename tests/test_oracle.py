"""Every registered query equals its DuckDB oracle (sf0.001 here; the driver
checks sf0.01). Values compared as text, columns sorted by name."""

from __future__ import annotations

import math

import pytest

import __spark_entry__ as E
from reviewlake.plans.registry import ORACLE, QUERIES
from tests.conftest import SF_SMALL

NAMES = sorted(QUERIES)


def _norm(v):
    if v is None:
        return "<NULL>"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 6):.6f}"
    if isinstance(v, bool):
        return str(v).lower()
    return str(v)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["verdict", "n"]
    assert {r.verdict for r in rows} == {"keep", "dropped", "truncated", "response not english"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    got = sorted(tuple(_norm(r[i]) for i in order) for r in df.collect())
    rel = duck.sql(E.oracle_sql()[name])
    ocols = rel.columns
    oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
    want = sorted(tuple(_norm(r[i]) for i in oorder) for r in rel.fetchall())
    assert sorted(cols) == sorted(ocols)
    assert got == want
    from tools.oracle_check import SPARK_TO_DUCK
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    assert spark_types == dict(zip(ocols, [str(t) for t in rel.types]))
