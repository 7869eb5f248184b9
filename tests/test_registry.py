"""Every registered query against its DuckDB oracle (sf0.001), plus the entry smoke check."""

import pytest

import __spark_entry__ as E
from tests.compare import compare, duck
from tests.conftest import SF001


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_an_oracle():
    assert set(E.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    assert compare(df, con, E.oracle_sql()[name]) == []


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["country", "production_value", "producer_rank", "year", "month"]
    assert df.count() > 0
