"""M1-M7 as runnable jobs: read inputs, apply the plan, replace the target table.

Only this module and ``sources`` read or write; every transform is
DataFrame -> DataFrame.  Each job writes a whole table, which is also where
lineage is cut between jobs: a rerun of a later job starts from the written
table, not from bronze.  Every runner returns what was observed while its table was
written: ``rows``, and for the logs their hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..functions.events import SMS_RESPONSE, SMS_RESPONSE_CORRECTED
from ..functions.time import LOCAL_TZ
from ..sources.catalog import count_hot_keys, known_hot_keys, read_table, replace_table
from ..sources.files import read_bronze
from ..sources.jdbc import DEFAULT_CONNECTIONS, sync_tables
from .comm_logs import communication_logs_flat
from .engagement import sms_engagement, whatsapp_engagement
from .lead_360 import LEAD_KEYS, LOG_KEYS, join_sides, lead_side, log_side
from .lead_flat import INPUT_COLUMNS, lead_flat
from .response import campaign_response

Observed = dict[str, Any]


def run_lead_flat(spark: SparkSession, bronze_path: str, target: str, buckets: int | None = None) -> Observed:
    """M1.  With ``buckets`` the table is bucketed by the keys on which M3 joins it."""
    return replace_table(
        lead_flat(read_bronze(spark, bronze_path, INPUT_COLUMNS)), target,
        bucket_by=(buckets, LEAD_KEYS) if buckets else None)


def run_communication_logs(spark: SparkSession, bronze_path: str, target: str, buckets: int | None = None) -> Observed:
    """M2.  The keys of leads that hold a large share of the logs are found on the way, for
    M3's join.  ``buckets`` as in M1; the same number makes that join free of exchanges."""
    return replace_table(
        communication_logs_flat(read_bronze(spark, bronze_path, ["payload"])), target,
        bucket_by=(buckets, LOG_KEYS) if buckets else None, hot_keys=LOG_KEYS)


SKEW_SAFE_CONF = "spark.leadlake.skewSafeJoin"
LABELS_ONCE_CONF = "spark.leadlake.labelsOnce"
SMS_RULES = {"shipped": SMS_RESPONSE, "corrected": SMS_RESPONSE_CORRECTED}


def _is_set(spark: SparkSession, conf: str, default: str) -> bool:
    return spark.conf.get(conf, default).lower() == "true"


def lead_360_of(
    spark: SparkSession, lead_flat_table: str, logs_table: str, projects: DataFrame, labels: DataFrame,
    skew_safe: bool | None = None, labels_once: bool | None = None,
) -> DataFrame:
    """M3's plan as its job runs it, each table read once.

    Leads with a large share of the logs (``spark.leadlake.skewSafeJoin``, on by default) are
    joined in salted form; which these are the logs' table remembers, and only tables of
    other catalogs are looked through for it (three columns, one small aggregate).  Without
    such leads it is a plain left join, and of tables in the same number of buckets one
    without exchanges.  ``spark.leadlake.labelsOnce`` (off by default) joins the label roles
    in one go, for label tables that no broadcast fits."""
    skew_safe = _is_set(spark, SKEW_SAFE_CONF, "true") if skew_safe is None else skew_safe
    labels_once = _is_set(spark, LABELS_ONCE_CONF, "false") if labels_once is None else labels_once
    flat = read_table(spark, logs_table)
    hot = known_hot_keys(spark, logs_table, LOG_KEYS) if skew_safe else []
    if hot is None:
        hot = count_hot_keys(flat, LOG_KEYS)
    leads = lead_side(read_table(spark, lead_flat_table), projects, labels, labels_once)
    return join_sides(leads, log_side(flat, labels), hot=hot)


def run_lead_360(
    spark: SparkSession,
    lead_flat_table: str,
    logs_table: str,
    projects_path: str,
    labels_path: str,
    target: str,
    skew_safe: bool | None = None,
) -> Observed:
    """M3 (see ``lead_360_of``).  Nothing is staged, so a run that fails leaves nothing behind."""
    return replace_table(lead_360_of(
        spark, lead_flat_table, logs_table, read_bronze(spark, projects_path), read_bronze(spark, labels_path),
        skew_safe), target)


def run_sms_engagement(
    spark: SparkSession, sms_path: str, campaigns_path: str, lead_360_table: str, target: str,
    org_column: str | None = None, tz: str = LOCAL_TZ, phone_rule: str = "digits",
) -> Observed:
    """M4."""
    df = sms_engagement(
        read_bronze(spark, sms_path), read_bronze(spark, campaigns_path),
        read_table(spark, lead_360_table), tz=tz, org_column=org_column, phone_rule=phone_rule,
    )
    return replace_table(df, target)


def run_whatsapp_engagement(
    spark: SparkSession, whatsapp_path: str, campaigns_path: str, lead_360_table: str, target: str,
    tz: str = LOCAL_TZ, phone_rule: str = "digits",
) -> Observed:
    """M5."""
    df = whatsapp_engagement(
        read_bronze(spark, whatsapp_path), read_bronze(spark, campaigns_path),
        read_table(spark, lead_360_table), tz=tz, phone_rule=phone_rule,
    )
    return replace_table(df, target)


def run_campaign_response(
    spark: SparkSession, sms_path: str, whatsapp_path: str, email_path: str,
    lead_360_table: str, target: str, tz: str = LOCAL_TZ, sms_rules: str = "shipped",
    dedupe_dim: bool = True,
) -> Observed:
    """M6.  ``sms_rules`` names a preset of ``SMS_RULES``."""
    df = campaign_response(
        read_bronze(spark, sms_path, ["projectId"]), read_bronze(spark, whatsapp_path, ["payload"]),
        read_bronze(spark, email_path, ["projectId"]), read_table(spark, lead_360_table),
        tz=tz, sms_rules=SMS_RULES[sms_rules], dedupe_dim=dedupe_dim,
    )
    return replace_table(df, target)


def run_sync_to_rdbms(
    spark: SparkSession, mapping: Mapping[str, str], url: str, properties: Mapping[str, str],
    truncate: bool = False, num_partitions: int = DEFAULT_CONNECTIONS,
) -> dict[str, int]:
    """M7: copy each silver table to the database (full refresh); returns row counts."""
    return sync_tables(spark, mapping, url, properties, truncate=truncate, num_partitions=num_partitions)
