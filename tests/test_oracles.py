"""Every registered query against its DuckDB oracle (small scale factor)."""

import pytest

import __spark_entry__ as entry
from tests_support import SF, compare_one
from tideline.plans import registry

NAMES = sorted(registry.queries())


@pytest.fixture(scope="module")
def con():
    from oracle_check import duck

    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare_one(spark, con, name)
    assert ok, msg


def test_every_query_has_an_oracle():
    assert set(registry.oracle_sql()) == set(registry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries()) >= set(NAMES)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert [f.name for f in df.schema.fields] == ["t", "event_type", "rows", "value_sum", "value_min", "value_max"]
    assert df.count() > 0
