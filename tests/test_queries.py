"""Every registered query against its SQL, on the smallest tables."""

import __spark_entry__ as entry_points
import oracle
import pytest

FOLDER = "/root/testdata/sf0.001"
PLANS, SQL = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    oracle.compare(spark, con, PLANS[name], SQL[name], FOLDER)


@pytest.mark.parametrize("name", sorted(set(PLANS) - set(SQL)))
def test_gives_rows(spark, name):
    assert PLANS[name](spark, FOLDER).count() > 0


def test_every_sql_has_a_plan():
    assert set(SQL) <= set(PLANS)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 10
