"""Every registered query against its SQL statement, or for rows where there is none."""

import pytest

import catalog
from catalog.check import check_engine, compare
from tests.conftest import SF_DIR

catalog.load_all()


@pytest.fixture(scope="module")
def engine():
    return check_engine(SF_DIR)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf_dir, engine, name):
    assert compare(spark, engine, sf_dir, name) is None


def test_entry(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).count() >= 25
    assert set(entry.oracle_sql()) <= set(entry.queries())
