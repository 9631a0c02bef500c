"""Every registered query against its SQL on the smallest test tables."""

import re

import pytest

import __spark_entry__ as entry
from tests.oracle import differences, duck

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


@pytest.mark.parametrize(
    "name", ["activity_labels", "retention_chart", "retention_observed_salted"]
)
def test_every_table_is_read_once(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    read = re.findall(rf"{SF_DIR}/(\w+)\.parquet", plan)
    assert len(read) == len(set(read)) > 0
