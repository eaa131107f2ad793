"""M1: bronze leads (JSON text columns) -> ``lead_flat``, 56 string columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import schemas as S
from ..operators.flatten import flatten
from ..operators.guards import json_text, safe_scalar, safe_struct

# ---- fixed values: output columns ------------------------------------------
ROOT_COLUMNS = (
    "_id", "orgId", "leadId", "isActive", "createdAt", "createdBy", "creatorId", "projectId",
    "updatedAt", "updatedBy", "assigneeId", "leadStatus", "leadStatusChangeReason", "background",
    "followUpDate", "followUpTime", "nextFollowUp", "callHyperLink", "chatHyperLink",
    "latestComment", "nextSiteVisit", "stageChangedAt", "totalUnreadMsgs", "totalMissedCalls",
    "assignmentHistory", "dispositionCallSid", "leadCreationSource", "siteVisitDoneCount",
)
# raw JSON text kept next to the parsed fields: (output name, input column)
RAW_JSON_COLUMNS = (
    ("original_siteVisit_json", "siteVisit"),
    ("propertyInterest", "propertyInterest"),
    ("conversionPropensity", "conversionPropensity"),
    ("profile", "profile"),
)
# text columns that are read where a file has them
INPUT_COLUMNS = (*ROOT_COLUMNS, *[src for _, src in RAW_JSON_COLUMNS])
PROFILE_OUT = (
    "fullName", "email", "age", "gender", "currentLocation", "alternateNumber", "whatsAppNumber",
    "sourceOfLead", "subSourceOfLead", "referralSource", "agentName",
)
CONVERSION_OUT = ("probability", "leadIntent")
OUTPUT_COLUMNS = (
    list(ROOT_COLUMNS)
    + [out for out, _ in RAW_JSON_COLUMNS]
    + [f"profile_{f}" for f in PROFILE_OUT]
    + [f"propertyInterest_{f}" for f in S.PROPERTY_INTEREST_FIELDS]
    + [f"conversionPropensity_{f}" for f in CONVERSION_OUT]
    + [f"siteVisit_{f}" for f in S.SITE_VISIT_FIELDS]
)


def lead_flat(bronze: DataFrame) -> DataFrame:
    """Every input column is optional: an absent scalar is a NULL string (C3) and an
    absent JSON column parses to a NULL struct (C2).  JSON columns may be text or native
    structs.  Each is parsed once, and the job is map-only."""
    parsed = bronze.select(
        *[safe_scalar(bronze, c).alias(c) for c in ROOT_COLUMNS],
        *[json_text(bronze, src).alias(out) for out, src in RAW_JSON_COLUMNS],
        safe_struct(bronze, "profile", S.profile_schema()).alias("__profile"),
        safe_struct(bronze, "propertyInterest", S.property_interest_schema()).alias("__prop"),
        safe_struct(bronze, "conversionPropensity", S.conversion_propensity_schema()).alias("__conv"),
        safe_struct(bronze, "siteVisit", S.site_visit_schema()).alias("__sv"),
    )
    return parsed.select(
        *ROOT_COLUMNS,
        *[out for out, _ in RAW_JSON_COLUMNS],
        *flatten("__profile", "profile", PROFILE_OUT),
        *flatten("__prop", "propertyInterest", S.PROPERTY_INTEREST_FIELDS),
        *flatten("__conv", "conversionPropensity", CONVERSION_OUT),
        *flatten("__sv", "siteVisit", S.SITE_VISIT_FIELDS),
    )
