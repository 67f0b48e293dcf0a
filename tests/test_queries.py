"""Every registered query against its SQL on the smallest test data."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import _QUERIES, entry
from check_oracles import compare, connect
from oracles import oracle_sql as telemetry_sql

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(_QUERIES) == set(telemetry_sql())


@pytest.mark.parametrize("name", sorted(_QUERIES))
def test_query(spark, con, name):
    mine, theirs, _ = compare(spark, con, FOLDER, name)
    assert mine == theirs


def test_entry(spark):
    assert entry(spark).count() == 20
