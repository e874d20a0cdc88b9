"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import checks.queries
from checks.compare import compare, connect
from tests.conftest import SF
from __spark_entry__ import entry, oracle_sql, queries

QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.fixture(scope="module", autouse=True)
def one_training(spark):
    """Train once for all model queries."""
    table, model = checks.queries.trained(spark, SF)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(checks.queries, "trained", lambda spark, sf: (table, model))
        yield


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert compare(spark, duck, name, QUERIES[name], SQL.get(name), SF) is None


def test_entry(spark):
    row = entry(spark).first()
    assert (row.total, row.labelled, row.smart_tp, row.smart_fp) == (920, 40, 40, 28)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
