"""Every query against DuckDB over the same tables."""

from __future__ import annotations

import os

import pytest
from compare import assert_same, duckdb_over

import oracle
from tarmac.plans import registry

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
SQL = oracle.sql()


@pytest.fixture(scope="module")
def con():
    return duckdb_over(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(SQL) == set(registry.queries())


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_matches_oracle(spark, con, name):
    assert_same(registry.queries()[name](spark, SF_DIR), con, SQL[name])
