"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as registry
import parity
from civicloom.plans import catalog, oracle


@pytest.fixture(scope="module")
def con(sf):
    return parity.duck(sf)


def test_registry_is_consistent():
    assert set(oracle.SQL) == set(catalog.QUERIES)
    assert set(oracle.SQL) <= set(registry.oracle_sql()) <= set(registry.queries())


def test_entry(spark):
    df = registry.entry(spark)
    assert df.columns[:2] == ["complaint_date", "borough"] and df.count() > 0


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, con, sf, name):
    state, note = parity.compare(spark, con, name, sf)
    assert state == "ok", note
