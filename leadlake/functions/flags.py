"""Business flags over lead / log columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import is_present

# ---- fixed values -----------------------------------------------------------
BOOKED_LABEL = "booked"
SITE_VISIT_DONE_STATUSES = ("SV_DONE",)
CONNECTED_CALL_STATUSES = ("connected", "answered", "completed", "in-progress")


def null_to_false(flag: Column) -> Column:
    """E16."""
    return F.coalesce(flag, F.lit(False))


def site_visit_scheduled(lead_json: Column, log_next_visit: Column, *log_fields: Column) -> Column:
    """A visit is scheduled when the lead's site-visit JSON is present (F2),
    else the log's next-visit text is present (F2), else any of the log's
    visit fields is non-NULL.  Never NULL."""
    cond = is_present(lead_json) | is_present(log_next_visit)
    for f in log_fields:
        cond = cond | f.isNotNull()
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def _is_booked(booking_id: Column, label: Column) -> Column:
    return booking_id.isNotNull() & (F.lower(label) == BOOKED_LABEL)


def booked_flag(booking_id: Column, label: Column) -> Column:
    """1 when a booking id exists and the current label is "booked" (any case)."""
    return F.when(_is_booked(booking_id, label), F.lit(1)).otherwise(F.lit(0))


def booked_date(booking_id: Column, label: Column, created_at: Column) -> Column:
    """The log's creation time when booked (E3), else NULL."""
    return F.when(_is_booked(booking_id, label), created_at.cast("string")).otherwise(
        F.lit(None).cast("string")
    )


def site_visit_completed(sub_status: Column) -> Column:
    """E5: exact (case-sensitive) sub-status match; NULL -> FALSE."""
    return F.coalesce(sub_status.isin(*SITE_VISIT_DONE_STATUSES), F.lit(False))


def lead_temperature(conversion_json: Column) -> Column:
    """E6."""
    return F.get_json_object(conversion_json, "$.leadIntent")


def sms_raw_status(provider_response: Column, log_type: Column, payload: Column, log_id: Column) -> Column:
    """First non-NULL of provider code, log type, payload status, log id; lower-cased."""
    return F.lower(
        F.coalesce(
            F.get_json_object(provider_response, "$.status.code"),
            log_type.cast("string"),
            F.get_json_object(payload, "$.status"),
            log_id.cast("string"),
        )
    )


def call_connected(duration: Column, status: Column) -> Column:
    """1 when the cleaned duration text is a number above zero, or the call
    status is one of the connected statuses; else 0.  Text that is not a number
    after cleaning (``1.2.3``, empty) counts as no duration."""
    cleaned = F.regexp_replace(F.coalesce(duration.cast("string"), F.lit("0")), "[^0-9.]", "")
    by_duration = cleaned.try_cast("double") > 0
    by_status = F.lower(F.coalesce(status, F.lit(""))).isin(*CONNECTED_CALL_STATUSES)
    return F.when(F.coalesce(by_duration, F.lit(False)) | by_status, F.lit(1)).otherwise(F.lit(0))


def flag_if(cond: Column) -> Column:
    """0/1 integer of a condition, NULL counted as 0 (the ``when(c, 1).otherwise(0)`` idiom)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))
