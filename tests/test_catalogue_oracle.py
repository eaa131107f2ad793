"""Every registered query against its DuckDB SQL on the smallest test tables."""

import os

import pytest
from oracle_compare import compare, duck

import __spark_entry__ as entry
from leadlake.plans.catalogue import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:5] == ["campaignid", "campaignname", "campaignchannel", "orgId", "event_date"]
    assert df.count() >= 0


@pytest.mark.parametrize("zone", ["Asia/Kolkata", "America/New_York"])
@pytest.mark.parametrize("name", ["local_event_day", "epoch_ms_day", "whatsapp_funnel", "channel_pivot"])
def test_time_queries_do_not_depend_on_session_zone(spark, con, zone, name):
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        ok, msg = compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert ok, msg
