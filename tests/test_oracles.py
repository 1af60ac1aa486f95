"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from kestrel.plans.verify import compare

from conftest import SMOKE

SQL = oracle_sql()


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    res = compare(queries()[name](spark, SMOKE), duck, SQL[name])
    assert res["ok"], res


@pytest.mark.parametrize("name", sorted(set(queries()) - set(SQL)))
def test_query_without_oracle_runs(spark, name):
    df = queries()[name](spark, SMOKE)
    assert df.count() >= 0


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["COUNTRY_NAME", "DEST_FREQUENCY", "ORIGIN_FREQUENCY", "OUTWARDNESS"]
