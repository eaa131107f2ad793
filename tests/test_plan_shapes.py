"""Scale guards on the physical plans of the jobs (see PLANS.md)."""

import os
import re

import pytest

from leadlake.plans import testbed as T
from leadlake.plans.catalogue import lead_360_inputs
from leadlake.plans.comm_logs import communication_logs_flat
from leadlake.plans.engagement import sms_engagement, whatsapp_engagement
from leadlake.plans.lead_360 import lead_360
from leadlake.plans.lead_flat import lead_flat
from leadlake.plans.response import campaign_response

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

FORBIDDEN = ("Expand", "SortAggregate", "CartesianProduct", "BroadcastNestedLoopJoin",
             "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


@pytest.fixture(scope="module")
def plans(spark, tmp_path_factory):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")  # untruncated ReadSchema
    base = tmp_path_factory.mktemp("silver")
    lf, lg, pr, lb = lead_360_inputs(spark, SF)
    lf.write.parquet(str(base / "lf"))
    lg.write.parquet(str(base / "lg"))
    m3 = lead_360(spark.read.parquet(str(base / "lf")), spark.read.parquet(str(base / "lg")), pr, lb)
    m3.write.parquet(str(base / "m3"))
    dim = spark.read.parquet(str(base / "m3"))
    ev = T.table(spark, SF, "events")
    camp = T.campaigns(T.table(spark, SF, "part"))
    dfs = {
        "m1": lead_flat(T.leads_bronze(T.table(spark, SF, "customer"))),
        "m2": communication_logs_flat(T.comm_logs_bronze(T.table(spark, SF, "orders"))),
        "m3": m3,
        "m4": sms_engagement(T.sms_logs(ev), camp, dim),
        "m5": whatsapp_engagement(T.whatsapp_logs(ev), camp, dim),
        "m6": campaign_response(T.sms_webhooks(ev), T.whatsapp_webhooks(ev), T.email_webhooks(ev), dim),
    }
    out = {k: df._jdf.queryExecution().executedPlan().toString() for k, df in dfs.items()}
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    return out


@pytest.mark.parametrize("job", ["m1", "m2", "m3", "m4", "m5", "m6"])
def test_no_forbidden_operators(plans, job):
    found = [op for op in FORBIDDEN if op in plans[job]]
    assert not found, found


def test_funnels_prune_the_wide_dimension(plans):
    # the funnels read a handful of lead-360 columns, not all 163
    for job in ("m4", "m5"):
        scan = [ln for ln in plans[job].splitlines() if "FileScan parquet" in ln and "/m3" in ln][0]
        schema = re.search(r"ReadSchema: struct<(.*)>", scan).group(1)
        assert 3 <= len(re.findall(r"[A-Za-z_0-9]+:", schema)) <= 10, schema


def test_lookups_are_broadcast_when_small(plans):
    for job in ("m3", "m4", "m5"):
        assert "BroadcastHashJoin" in plans[job] or "BroadcastExchange" in plans[job]


def test_flattening_jobs_are_map_only(plans):
    for job in ("m1", "m2"):
        assert "Exchange" not in plans[job]


def test_funnel_scans_read_only_used_columns(plans):
    for job, unused in (("m4", "event_type"), ("m5", "value")):
        scan = [ln for ln in plans[job].splitlines() if "FileScan parquet" in ln and "/events" in ln][0]
        assert unused + ":" not in re.search(r"ReadSchema: struct<(.*)>", scan).group(1)
        for exchange in (ln for ln in plans[job].splitlines() if "Exchange hashpartitioning" in ln):
            assert "updatedAt" not in exchange and "profileId" not in exchange


def test_check_data_fills_every_column(spark):
    from leadlake.plans import catalogue
    from pyspark.sql import functions as F

    for query, empty in (("lead_flat", []), ("comm_logs_flat", []), ("lead_360", ["pms_LeadId"])):
        df = catalogue.QUERIES[query](spark, SF)
        filled = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).collect()[0].asDict()
        assert [c for c in df.columns if not filled[c]] == empty, query


def test_lead_dimension_of_the_checks_has_several_rows_per_lead(spark):
    dim = T.lead_dim(T.table(spark, SF, "customer"), T.table(spark, SF, "orders"))
    assert dim.count() > 2 * dim.select("leadId").distinct().count()
    assert dim.groupBy("leadId").agg({"bookingId": "count", "*": "count"}).where(
        "`count(bookingId)` > 0 AND `count(bookingId)` < `count(1)`").count() > 0
