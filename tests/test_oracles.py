"""Every registered query with an oracle must match DuckDB on the driver tables."""

import pytest

import __spark_entry__ as entry_mod
from oracle_harness import compare, duck

ORACLES = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_oracle):
    return duck(sf_oracle)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf_oracle, con, name):
    df = entry_mod.queries()[name](spark, sf_oracle)
    ok, msg = compare(df, con, ORACLES[name])
    assert ok, f"{name}: {msg}"


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["o_orderpriority", "mean", "count"]
    assert df.count() >= 0
