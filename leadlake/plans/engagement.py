"""M4 / M5: distinct-lead engagement funnels per campaign and first-event day.

Plan shape (per job):
  logs (campaignId IS NOT NULL, pushed to the scan; parsed once per row)
    -> pre-aggregate per campaign x phone key (x org): first time, max event flags
                                                         [shuffle 1, map-side combine]
    -> campaign lookup (Spark broadcasts it when it is small)
    -> INNER join to the reduced lead dimension on phone key (+ org)
       (the original left join + ``leadId IS NOT NULL`` filter, written as what it is)
    -> lead_flags: one row per campaign key x lead      [shuffle, partial agg]
    -> funnel_counts: per campaign key x day             [shuffle, partial agg]

The lead dimension is reduced to one row per lead x phone key (x org) with the max
of every flag as integers [shuffle, partial agg]: the funnel takes maxima per lead
anyway, and this keeps lead 360's lead x log fan-out out of the join.  Both sides
are keyed with the same ``phone_key`` rule, so formatting differences (``+91``,
spaces, dashes) no longer decide whether a log finds its lead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.events import (
    PASSTHROUGH,
    WHATSAPP_ENGAGEMENT,
    canonical_event,
    sms_engagement_event,
)
from ..functions.flags import booked_flag, call_connected, flag_if, null_to_false
from ..functions.text import digits, normalize_phone, phone_key
from ..functions.time import LOCAL_TZ, local_event_time, local_event_time_from_epoch_ms
from ..operators.funnel import funnel_counts, lead_flags
from ..operators.guards import ensure_columns, safe_struct
from ..operators.joins import lookup
from .lead_360 import LABEL_STATUS

CAMPAIGN_KEYS = ["campaignid", "campaignname", "campaignchannel"]

PhoneKey = Callable[[Column], Column]


def _unchanged(number: Column) -> Column:
    return number


# How a log finds its lead: (key of the log's number, key of the lead's number).
# "digits" compares national numbers however they are written.  "as_stored" compares the
# log's plain digits with the number as the dimension stores it (SMS: its normalised
# form, WhatsApp: the raw text), for reconciling counts with tables built that way.
PHONE_RULES: dict[str, dict[str, tuple[PhoneKey, PhoneKey]]] = {
    "digits": {"sms": (phone_key, phone_key), "whatsapp": (phone_key, phone_key)},
    "as_stored": {"sms": (digits, normalize_phone), "whatsapp": (digits, _unchanged)},
}

_PROVIDER_RESPONSE = StructType([
    StructField("status", StructType([
        StructField("code", StringType()), StructField("desc", StringType()),
    ])),
])
_WHATSAPP_PAYLOAD = StructType([
    StructField("recipient", StructType([StructField("to", StringType())])),
    StructField("events", StructType([StructField("timestamp", StringType())])),
    StructField("projectId", StringType()),
])


def reduce_lead_dim(
    lead_dim: DataFrame, with_org: bool, with_calls: bool, lead_key: PhoneKey = phone_key
) -> DataFrame:
    """One row per lead x phone key (x org) with the max of each lead-level flag;
    ``lead_key`` makes the key from the lead's number.

    Expects lead-360 columns: ``leadId``, ``orgId``, ``profile_whatsAppNumber``,
    ``site_visit_scheduled``, ``siteVisit_date``, ``bookingId``, the status label
    and, for calls, ``callDuration`` / ``callStatus``."""
    keys = ["leadId", "phone_key"] + (["orgId"] if with_org else [])
    aggs = [
        F.max(null_to_false(F.col("site_visit_scheduled"))).alias("site_visit_scheduled"),
        # only "some visit date exists" is used downstream: an integer flag keeps
        # this a hash aggregate (a max over strings would force a sort aggregate)
        F.max(flag_if(F.col("siteVisit_date").isNotNull())).alias("site_visit_delivered"),
        F.max(booked_flag(F.col("bookingId"), F.col(LABEL_STATUS))).alias("booked_flag"),
    ]
    if with_calls:
        aggs.append(F.max(call_connected(F.col("callDuration"), F.col("callStatus"))).alias("calls_connected_flag"))
    return (
        lead_dim.select("*", lead_key(F.col("profile_whatsAppNumber")).alias("phone_key"))
        .where(F.col("leadId").isNotNull() & F.col("phone_key").isNotNull())
        .groupBy(*keys)
        .agg(*aggs)
    )


def _lead_flag_exprs(extra: dict) -> dict:
    flags = dict(extra)
    flags["site_visit_scheduled_flag"] = flag_if(F.col("site_visit_scheduled") == F.lit(True))
    flags["site_visit_delivered_flag"] = F.col("site_visit_delivered")
    flags["booked_flag"] = F.col("booked_flag")
    return flags


def preaggregate_logs(logs: DataFrame, keys: list[str], ts: str, event_flags: dict) -> DataFrame:
    """One row per campaign x phone key (x org): first event time and the max of
    each 0/1 event flag.

    Exact, because the funnel only takes ``min`` of times and ``max`` of flags per
    campaign x lead, and every lead reached through a phone sees all of that
    phone's logs.  It runs with map-side partial aggregation, so a hot campaign or
    a hot number collapses before the shuffle, and the lead join below pairs
    leads with campaigns rather than with individual log rows."""
    return (
        logs.where(F.col("to_key").isNotNull())
        .groupBy(*keys)
        .agg(F.min(ts).alias("first_ts"), *[F.max(e).alias(n) for n, e in event_flags.items()])
    )


def sms_engagement(
    sms_logs: DataFrame,
    campaigns: DataFrame,
    lead_dim: DataFrame,
    tz: str = LOCAL_TZ,
    org_column: str | None = None,
    phone_rule: str = "digits",
) -> DataFrame:
    """M4.  ``org_column`` names the log's org column when it has one; the lead is
    then matched within that org only (two orgs sharing a number stay apart).
    ``phone_rule`` is one of ``PHONE_RULES``."""
    log_key, lead_key = PHONE_RULES[phone_rule]["sms"]
    logs = ensure_columns(sms_logs, {"type": "string", "providerResponse": "string"})
    logs = logs.where(F.col("campaignId").isNotNull())
    ts_type = logs.schema["createdAt"].dataType
    status = safe_struct(logs, "providerResponse", _PROVIDER_RESPONSE).getField("status")
    logs = logs.select(
        F.col("campaignId"),
        log_key(F.col("to")).alias("to_key"),
        sms_engagement_event(
            status.getField("code"), status.getField("desc"), F.col("type").cast("string")
        ).alias("canonical_event"),
        local_event_time(F.col("createdAt"), ts_type, tz).alias("event_ts_local"),
        *([F.col(org_column).alias("log_org")] if org_column else []),
    )
    keys = ["campaignId", "to_key"] + (["log_org"] if org_column else [])
    logs = preaggregate_logs(logs, keys, "event_ts_local", {
        "has_sms_delivered": flag_if(F.col("canonical_event") == "delivered"),
    })
    logs = lookup(
        logs, campaigns, on=[("campaignId", "_id")],
        columns={"name": "campaignname", "channel": "campaignchannel"},
        role="campaign",
    )
    leads = reduce_lead_dim(lead_dim, org_column is not None, True, lead_key)
    cond = F.col("to_key") == F.col("phone_key")
    if org_column:
        cond = cond & (F.col("log_org") == F.col("orgId"))
    rows = logs.join(leads, cond, "inner").withColumnRenamed("campaignId", "campaignid")
    flags = lead_flags(
        rows, CAMPAIGN_KEYS, "leadId", "first_ts",
        _lead_flag_exprs({
            "has_sms_delivered": F.col("has_sms_delivered"),
            "calls_connected_flag": F.col("calls_connected_flag"),
        }),
    )
    one = F.lit(1)
    return funnel_counts(flags, CAMPAIGN_KEYS, {
        "sms_delivered_unique": F.col("has_sms_delivered") == one,
        "calls_connected_unique": F.col("calls_connected_flag") == one,
        "site_visit_scheduled_any_unique": F.col("site_visit_scheduled_flag") == one,
        "site_visit_delivered_any_unique": F.col("site_visit_delivered_flag") == one,
        "booked_any_unique": F.col("booked_flag") == one,
    })


def whatsapp_engagement(
    wa_logs: DataFrame,
    campaigns: DataFrame,
    lead_dim: DataFrame,
    tz: str = LOCAL_TZ,
    phone_rule: str = "digits",
) -> DataFrame:
    """M5: campaign lookup on id and org; lead matched on phone key and org."""
    log_key, lead_key = PHONE_RULES[phone_rule]["whatsapp"]
    pl = safe_struct(wa_logs, "payload", _WHATSAPP_PAYLOAD)
    logs = wa_logs.where(F.col("campaignId").isNotNull()).select(
        "campaignId",
        "organisationId",
        canonical_event(F.col("status"), WHATSAPP_ENGAGEMENT, PASSTHROUGH).alias("canonical_event"),
        log_key(pl.getField("recipient").getField("to")).alias("to_key"),
        local_event_time_from_epoch_ms(pl.getField("events").getField("timestamp"), tz).alias("event_ts_local"),
    )
    ev = F.col("canonical_event")
    logs = preaggregate_logs(logs, ["campaignId", "organisationId", "to_key"], "event_ts_local", {
        "has_whatsapp_read": flag_if(ev == "read"),
        "has_whatsapp_click": flag_if(ev == "click"),
        "has_whatsapp_delivered": flag_if(ev == "delivered"),
    })
    logs = lookup(
        logs, campaigns, on=[("campaignId", "_id"), ("organisationId", "organisationId")],
        columns={"name": "campaignname", "channel": "campaignchannel"},
        role="campaign",
    )
    leads = reduce_lead_dim(lead_dim, True, False, lead_key)
    leads = leads.withColumnRenamed("orgId", "lead_org")
    cond = (F.col("to_key") == F.col("phone_key")) & (F.col("organisationId") == F.col("lead_org"))
    rows = logs.join(leads, cond, "inner").withColumnsRenamed(
        {"campaignId": "campaignid", "organisationId": "orgId"}
    )
    keys = CAMPAIGN_KEYS + ["orgId"]
    flags = lead_flags(
        rows, keys, "leadId", "first_ts",
        _lead_flag_exprs({
            "has_whatsapp_read": F.col("has_whatsapp_read"),
            "has_whatsapp_click": F.col("has_whatsapp_click"),
            "has_whatsapp_delivered": F.col("has_whatsapp_delivered"),
        }),
    )
    one, zero = F.lit(1), F.lit(0)
    read, click = F.col("has_whatsapp_read"), F.col("has_whatsapp_click")
    return funnel_counts(flags, keys, {
        "whatsapp_read_unique": read == one,
        "whatsapp_click_unique": click == one,
        "whatsapp_both_unique": (read == one) & (click == one),
        "whatsapp_read_only_unique": (read == one) & (click == zero),
        "whatsapp_click_only_unique": (click == one) & (read == zero),
        "whatsapp_delivered_unique": F.col("has_whatsapp_delivered") == one,
        "site_visit_scheduled_any_unique": F.col("site_visit_scheduled_flag") == one,
        "site_visit_delivered_any_unique": F.col("site_visit_delivered_flag") == one,
        "booked_any_unique": F.col("booked_flag") == one,
    })


SMS_OUTPUT = CAMPAIGN_KEYS + [
    "event_date", "total_unique_leads", "sms_delivered_unique", "calls_connected_unique",
    "site_visit_scheduled_any_unique", "site_visit_delivered_any_unique", "booked_any_unique",
]
WHATSAPP_OUTPUT = CAMPAIGN_KEYS + [
    "orgId", "event_date", "total_unique_leads", "whatsapp_read_unique", "whatsapp_click_unique",
    "whatsapp_both_unique", "whatsapp_read_only_unique", "whatsapp_click_only_unique",
    "whatsapp_delivered_unique", "site_visit_scheduled_any_unique",
    "site_visit_delivered_any_unique", "booked_any_unique",
]
