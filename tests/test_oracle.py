"""Every registered query equals its checking SQL on the small tables."""

import pytest

import __spark_entry__ as entry
from ripplekit.plans import catalog
from tools.check import compare, duck

KEYS = list(catalog.queries())


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_sql(spark, con, sf, key):
    result = compare(spark, con, sf, key)
    assert result.startswith("ok") and "types" not in result, result


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.limit(1).count() == 1
    assert {"id", "count", "male_count", "provname_en"} <= set(df.columns)


def test_every_query_has_sql():
    assert set(catalog.oracle_sql()) == set(KEYS)
    assert set(KEYS) <= set(entry.queries())
