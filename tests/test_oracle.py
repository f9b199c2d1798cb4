"""Every query with a DuckDB counterpart gives the same rows on the driver tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from terracover.plans.oracles import oracle_sql

ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    assert differences(entry.queries()[name](spark, sf_dir), duck, ORACLES[name]) == []


#: At the smallest scale the grid is lower than most polygons and these find nothing.
SPARSE = ["eligible_zones", "enough_per_class", "erode_mask", "label_stats", "training_table"]
MEDIUM = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", SPARSE)
def test_sparse_queries_find_rows(spark, name):
    if not os.path.isdir(MEDIUM):
        pytest.skip("driver tables are not available")
    found = entry.queries()[name](spark, MEDIUM).cache()
    assert not found.isEmpty()
    assert differences(found, connect(MEDIUM), ORACLES[name]) == []
