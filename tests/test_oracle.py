"""Every registered query with a SQL twin gives the rows DuckDB gives."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import differences, duck

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, connection, name):
    assert differences(QUERIES[name](spark, FOLDER), connection, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    result = entry.entry(spark)
    assert result.count() == 173
    assert "engagement_score" in result.columns


def test_sample_of_keys_takes_whole_keys(spark):
    from sluiceway import entities

    sampled = QUERIES["p12_sample_keys"](spark, FOLDER)
    users = sampled.select("user_id").distinct()
    assert entities.user_events(spark, FOLDER).join(users, "user_id", "left_semi").count() == sampled.count()


def test_approximate_percentile_is_close_in_rank(spark):
    from sluiceway import entities

    lines = entities.table(spark, FOLDER, "lineitem")
    for row in QUERIES["a17_approx_percentile"](spark, FOLDER).collect():
        group = lines.where(lines.l_returnflag == row.l_returnflag)
        share = group.where(group.l_extendedprice <= row.median_price).count() / group.count()
        assert abs(share - 0.5) < 0.001
