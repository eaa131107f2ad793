"""M6: campaign responses per lead and local day, pivoted by channel.

  sms / whatsapp / email webhook logs -> canonical event + local day per row
  -> union by name (U1)
  -> one groupBy of conditional sums for the 16 kept columns (A5/A6)   [1 shuffle]
  -> INNER join to the lead dimension reduced to distinct (lead_flat_id, leadId)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.events import EMAIL_RESPONSE, SMS_RESPONSE, WHATSAPP_RESPONSE, Rule, canonical_event
from ..functions.time import LOCAL_TZ, local_event_time
from ..operators.guards import ensure_column, json_text
from ..operators.pivot import PivotColumn, channel_pivot, union_channels

KEYS = ["event_date", "orgId", "projectId", "profileId"]

# ---- fixed values: kept pivot columns (output, channel, canonical event) -----
RESPONSE_COLUMNS: list[PivotColumn] = [
    ("EMAIL_SENT", "email", "sent"),
    ("EMAIL_DELIVERED", "email", "delivered"),
    ("EMAIL_OPENED", "email", "open"),
    ("EMAIL_CLICKED", "email", "click"),
    ("EMAIL_SPAM", "email", "spam"),
    ("EMAIL_UNSUBSCRIBED", "email", "unsubscribe"),
    ("WHATSAPP_SENT", "whatsapp", "sent"),
    ("WHATSAPP_DELIVERED", "whatsapp", "delivered"),
    ("WHATSAPP_READ", "whatsapp", "read"),
    ("WHATSAPP_CLICKED", "whatsapp", "click"),
    ("WHATSAPP_FAILED", "whatsapp", "failed"),
    ("WHATSAPP_REPLIED", "whatsapp", "reply"),
    ("SMS_SENT", "sms", "sent"),
    ("SMS_DELIVERED", "sms", "delivered"),
    ("SMS_FAILED", "sms", "failed"),
    ("SMS_CLICKED", "sms", "click"),
]
OUTPUT = ["leadId", "lead_flat_id", "event_date", "orgId", "projectId"] + [c for c, _, _ in RESPONSE_COLUMNS]


def channel_events(
    df: DataFrame,
    channel: str,
    ts_column: str,
    rules: Sequence[Rule],
    tz: str = LOCAL_TZ,
    project_from_payload: bool = False,
) -> DataFrame:
    """One channel's webhook log -> (event_date, orgId, projectId, profileId,
    canonical_event, channel).  Missing ``profileId`` / ``projectId`` become NULL (C4)."""
    df = ensure_column(df, "profileId")
    if not project_from_payload:
        df = ensure_column(df, "projectId")
    project = (
        F.get_json_object(json_text(df, "payload"), "$.projectId")
        if project_from_payload else F.col("projectId")
    )
    ts_type = df.schema[ts_column].dataType
    return df.select(
        F.to_date(local_event_time(F.col(ts_column), ts_type, tz)).alias("event_date"),
        F.col("organisationId").cast("string").alias("orgId"),
        project.cast("string").alias("projectId"),
        F.col("profileId").cast("string").alias("profileId"),
        canonical_event(F.col("status"), rules).alias("canonical_event"),
        F.lit(channel).alias("channel"),
    )


def campaign_response(
    sms: DataFrame,
    whatsapp: DataFrame,
    email: DataFrame,
    lead_dim: DataFrame,
    tz: str = LOCAL_TZ,
    sms_rules: Sequence[Rule] = SMS_RESPONSE,
    dedupe_dim: bool = True,
) -> DataFrame:
    events = union_channels(
        channel_events(sms, "sms", "updatedAt", sms_rules, tz),
        channel_events(whatsapp, "whatsapp", "updatedAt", WHATSAPP_RESPONSE, tz, project_from_payload=True),
        channel_events(email, "email", "createdAt", EMAIL_RESPONSE, tz),
    )
    agg = channel_pivot(events, KEYS, "channel", "canonical_event", RESPONSE_COLUMNS)
    dim = lead_dim.select("lead_flat_id", "leadId")
    if dedupe_dim:
        # lead 360 has one row per lead x log; without this every response row
        # would be repeated once per log of its lead
        dim = dim.distinct()
    out = agg.join(dim, F.col("profileId") == F.col("lead_flat_id"), "inner")
    return out.select(*OUTPUT)
