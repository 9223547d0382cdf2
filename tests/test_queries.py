"""Every registered query against its SQL on the smallest test tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries
from tests.compare import differences, open_oracle


@pytest.fixture(scope="module")
def oracle():
    return open_oracle(SMOKE_DIR)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, oracle, name):
    df = queries()[name](spark, SMOKE_DIR)
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.limit(1).count() == 1
    else:
        assert differences(df, oracle, sql) == []


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_oracle_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
