"""Every registered query against its SQL, on the given tables (TEST_SF_DIR, default sf0.001)."""

import pytest

import __spark_entry__ as contract
from tradewake.plans import catalog

from .compare import connect, differences

# The iterative fits; checked by their own tests.
WITHOUT_SQL = {"kmeans_segments", "ridge_segmented"}


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_only_the_fits_lack_sql():
    assert set(catalog.queries()) - set(catalog.oracle_sql()) == WITHOUT_SQL
    assert set(catalog.oracle_sql()) <= set(catalog.queries())
    assert set(catalog.queries()) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_equals_sql(name, spark, sf_dir, connection):
    found = catalog.queries()[name](spark, sf_dir)
    assert differences(found, connection, catalog.oracle_sql()[name]) == []


def test_entry_has_rows_and_stable_schema(spark):
    first, second = contract.entry(spark), contract.entry(spark)
    assert first.schema == second.schema
    assert first.count() > 0
