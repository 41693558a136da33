"""Every registered query equals its DuckDB oracle on sf0.001 (the driver
runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as E
from tests_helpers import SF_SMALL
from oracle_check import digest, duck

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    from tidewatch.plans.queries import QUERIES

    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    o_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(o_rows)
    assert digest(df.columns, rows)[0] == digest(rel.columns, o_rows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["seq", "deviceId", "eventType", "sensorType", "timestamp",
                          "suspicious", "value"]
