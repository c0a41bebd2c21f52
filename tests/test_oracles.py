"""Every query with an oracle matches DuckDB on the sf0.001 tables (order-insensitive)."""
import pytest

import __spark_entry__ as entry
from paths import SF_SMALL
from oracle_compare import compare, duck

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(ORACLES[name]).fetchdf()
    problem = compare(got, want)
    assert problem is None, f"{name}: {problem}"


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "spend_rolling_std_3" in df.columns
