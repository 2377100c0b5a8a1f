"""Every registered query against its SQL, on the tables of the driver's check."""

import pytest

from checks.queries import QUERIES, SQL
from checks.run import compare, connect
from tests.conftest import CHECKED, SMALL


@pytest.fixture(scope="module")
def db():
    return connect(CHECKED)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_equals_sql(spark, db, name):
    assert compare(QUERIES[name](spark, CHECKED), SQL[name], db) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
