"""Every registered query with an oracle equals DuckDB on sf0.001."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SF_SMALL
from helpers import duck_rows, rows_of

ORACLES = oracle_sql()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(queries())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["o_orderkey", "o_totalprice", "part_names", "line"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    expected, names = duck_rows(duck, ORACLES[name])
    assert sorted(df.columns) == names
    assert rows_of(df) == expected
