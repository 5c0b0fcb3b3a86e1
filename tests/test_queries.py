"""Every registered query against its SQL, over whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from eocube import bindings
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = bindings.queries(), bindings.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_sql(spark, con, key):
    df = QUERIES[key](spark, FOLDER)
    if key in ORACLES:
        assert compare(df, con, ORACLES[key]) == []
    else:
        assert df.count() > 0


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["y_idx", "x_idx", "class", "label"]
    assert df.count() > 0


def test_every_query_has_a_check():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())
