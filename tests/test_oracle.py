"""Every query with an oracle SQL matches DuckDB (rows, columns, values) on the small fixture."""

import pytest

import __spark_entry__ as E
from oracle_check import compare

from conftest import SF_SMALL

ORACLE = sorted(E.oracle_sql())


@pytest.mark.parametrize("name", ORACLE)
def test_matches_oracle(spark, duck_small, name):
    r = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL, duck_small)
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["cols_match"], r
    assert r["hash_match"], r


def test_every_query_has_a_callable_and_entry_runs(spark):
    q = E.queries()
    assert set(E.oracle_sql()) <= set(q)
    df = E.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 42
