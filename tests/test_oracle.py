"""Queries against their DuckDB twins, on the smallest tables."""

import pytest

from __spark_entry__ import entry
from compare import compare, duck
from registry.oracle import ORACLE
from registry.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_twin(spark, connection, name):
    assert compare(spark, connection, FOLDER, name) == ""


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry(spark).columns == [
        "year_month",
        "borough",
        "service_type",
        "total_revenue",
        "avg_tip_pct",
    ]
