"""Every registered query equals its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as entry
from costbook.plans import oracle, registry
from conftest import SF_SMALL
from tools.check_oracle import digest, duck

KEYS = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(oracle.statements())
    assert set(registry.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = registry.QUERIES[key](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(oracle.statements()[key])
    d_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(s_rows) == len(d_rows)
    assert digest(df.columns, s_rows)[0] == digest(rel.columns, d_rows)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["project_id", "job_id", "account"]
    assert df.count() >= 0
