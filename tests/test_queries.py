"""Every registered query against its checking SQL on the smallest tables."""

from __future__ import annotations

import pathlib

import pytest

import __spark_entry__ as entry_points
from check_oracles import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(SF_DIR).exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query(spark, con, name):
    ok, note = compare(spark, con, name, entry_points.queries()[name], entry_points.oracle_sql()[name], SF_DIR)
    assert ok, note


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
