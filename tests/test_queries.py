"""Every registered query against its SQL, and every other one for rows."""

import __spark_entry__ as entry
import pytest
from compare import difference, duck

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, folder, con, name):
    assert difference(entry.queries()[name](spark, folder), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(SQL)))
def test_gives_rows(spark, folder, name):
    assert entry.queries()[name](spark, folder).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 200
