"""Raw provider statuses -> canonical events, one operator with mappings as data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# A rule is (canonical event, case fold applied to the status, raw values).
# Rules are tried in order; the first match wins.
Rule = tuple[str, str, tuple[str, ...]]

PASSTHROUGH = "__lower_passthrough__"


def _fold(c: Column, how: str) -> Column:
    if how == "upper":
        return F.upper(c)
    if how == "lower":
        return F.lower(c)
    raise ValueError(f"unknown fold {how!r}")


def canonical_event(status: Column, rules: Sequence[Rule], default: str | None = None) -> Column:
    """Map ``status`` with ``rules``.

    ``default`` is what an unmatched status gives: ``None`` -> NULL,
    ``PASSTHROUGH`` -> the lower-cased status, any other text -> that text.
    """
    if not rules:
        raise ValueError("at least one rule is needed")
    expr = None
    for event, fold, values in rules:
        cond = _fold(status, fold).isin(*values)
        expr = F.when(cond, F.lit(event)) if expr is None else expr.when(cond, F.lit(event))
    if default is None:
        return expr
    if default == PASSTHROUGH:
        return expr.otherwise(F.lower(status))
    return expr.otherwise(F.lit(default))


# ---- fixed values: provider status vocabularies -----------------------------
# E9, WhatsApp engagement (unmatched -> lower-cased status)
WHATSAPP_ENGAGEMENT: list[Rule] = [
    ("read", "lower", ("read", "seen", "message_read")),
    ("click", "lower", ("click", "url_click")),
    ("delivered", "lower", ("delivered", "deliv")),
]

# E10, SMS response (unmatched -> NULL).  As shipped: DELIVRD counts as sent and
# FAILED is caught by the sent rule, so only UNDELIV reaches "failed".
SMS_RESPONSE: list[Rule] = [
    ("sent", "upper", (
        "SENT", "SUBMITD", "DELIVRD", "DLT HEADER FILTER", "DLT TEMPLATE FILTER",
        "DLT VL FAILURE", "EXP-ABS-SUB", "EXP-NW-FAIL", "EXPIRED", "FAILED", "INVALID REQUEST",
    )),
    ("failed", "upper", ("FAILED", "UNDELIV")),
    ("click", "lower", ("click",)),
]

# Corrected preset: DELIVRD is a delivery receipt, FAILED is a failure.
SMS_RESPONSE_CORRECTED: list[Rule] = [
    ("delivered", "upper", ("DELIVRD",)),
    ("failed", "upper", ("FAILED", "UNDELIV")),
    ("sent", "upper", (
        "SENT", "SUBMITD", "DLT HEADER FILTER", "DLT TEMPLATE FILTER", "DLT VL FAILURE",
        "EXP-ABS-SUB", "EXP-NW-FAIL", "EXPIRED", "INVALID REQUEST",
    )),
    ("click", "lower", ("click",)),
]

# E11, WhatsApp response (unmatched -> NULL)
WHATSAPP_RESPONSE: list[Rule] = [
    ("sent", "upper", ("QUEUED", "SENT")),
    ("delivered", "lower", ("delivered", "deliv")),
    ("read", "lower", ("read", "seen", "message_read")),
    ("click", "lower", ("click", "url_click")),
    ("failed", "lower", ("failed",)),
    ("reply", "lower", ("reply", "replied")),
]

# E12, email response (unmatched -> NULL)
EMAIL_RESPONSE: list[Rule] = [
    ("sent", "upper", ("PROCESSED", "DROPPED", "BOUNCED", "REJECTED", "SENT")),
    ("delivered", "lower", ("delivered",)),
    ("open", "lower", ("open", "opened")),
    ("click", "lower", ("click", "clicked")),
    ("spam", "lower", ("spam",)),
    ("unsubscribe", "lower", ("unsubscribe", "unsubscribed")),
]

# E8, SMS engagement: delivered when the provider code is 200, or its description
# contains "accept", or the log type says delivered; anything else is "other".
SMS_DELIVERED_CODE = "200"
SMS_ACCEPT_FRAGMENT = "accept"
SMS_DELIVERED_TYPES = ("delivered", "delivery")


def sms_engagement_event(code: Column, desc: Column, log_type: Column) -> Column:
    delivered = (
        (code == SMS_DELIVERED_CODE)
        | F.lower(desc).contains(SMS_ACCEPT_FRAGMENT)
        | F.lower(log_type).isin(*SMS_DELIVERED_TYPES)
    )
    return F.when(delivered, F.lit("delivered")).otherwise(F.lit("other"))
