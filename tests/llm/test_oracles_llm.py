"""Queries of this subpackage against their SQL, over the whole small tables."""
import sys
import os

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle_compare import compare, duck  # noqa: E402

from lineforge.llm import registry  # noqa: E402


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, sf, name):
    got = registry.queries()[name](spark, sf).toPandas()
    assert compare(got, duck(sf).execute(registry.oracle_sql()[name]).df()) is None


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.queries()) == list(range(1, 14))
