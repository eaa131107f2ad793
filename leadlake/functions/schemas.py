"""Declared schemas for the JSON text columns.

Field names are matched case-sensitively by ``from_json``; note ``whatsAppNumber``
on leads versus ``whatsappNumber`` inside log payloads.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    StringType,
    StructField,
    StructType,
)


def _struct(*fields: str | tuple[str, DataType]) -> StructType:
    """Struct of nullable fields; a bare name means a string field."""
    out = []
    for f in fields:
        name, dtype = (f, StringType()) if isinstance(f, str) else f
        out.append(StructField(name, dtype, True))
    return StructType(out)


# ---- fixed values: JSON keys of the lead document (bronze `leads`) ----------
PROFILE_FIELDS = (
    "fullName", "email", "age", "gender", "currentLocation", "alternateNumber",
    "whatsAppNumber", "sourceOfLead", "subSourceOfLead", "referralSource",
    "agentName", "additionalInfo",
)
PROPERTY_INTEREST_FIELDS = (
    "budgetRange", "carpetAreaSqFtRange", "preferredFloor", "preferredUnitType",
    "purposeOfProperty", "propertyStatus", "otherPreferences",
)
CONVERSION_PROPENSITY_FIELDS = ("description", "probability", "interactionNumber", "leadIntent")
SITE_VISIT_FIELDS = ("date", "time", "schedule", "modeOfVisit")


def profile_schema() -> StructType:
    return _struct(*PROFILE_FIELDS)


def property_interest_schema() -> StructType:
    return _struct(*PROPERTY_INTEREST_FIELDS)


def conversion_propensity_schema() -> StructType:
    return _struct(*CONVERSION_PROPENSITY_FIELDS)


def site_visit_schema() -> StructType:
    return _struct(*SITE_VISIT_FIELDS)


# ---- fixed values: JSON keys of the communication-log payload ---------------
def payload_schema() -> StructType:
    return _struct(
        "__v", "_id", "isActive", "createdAt", "createdBy", "updatedAt", "updatedBy",
        "projectId", "assigneeId", "prevAssigneeId", "nextSiteVisit", "leadStatus",
        "prevStatus", "leadStatusChangeReason", "logEventType", "status", "subStatus",
        ("viewed", BooleanType()), "remarks", "nextFollowUp",
        ("assignmentHistory", ArrayType(StringType())),
        "agentId", "agentName", "agentPhone", "chatHyperLink", "latestComment",
        ("background", _struct(
            "annualIncome", "assignedTo", "currentLocation", "fundingIsLoaned", "occupation",
            ("possessionDate", _struct("month", "year")),
            "qualification", "workLocation",
        )),
        "bookingId", "buildingId", "buildingName", "cancelledReason", "coOwnerDetails",
        ("conversionPropensity", _struct(
            ("breakdown", _struct("ability", "intent", "perception", "readiness")),
            "description", "interactionNumber", "probability",
        )),
        ("pricingDetails", _struct("agreementValue", "modeOfPayment", "tokenAmount")),
        ("profile", _struct(
            "fullName", "email", "gender", "age", "alternateNumber", "countryCode",
            "referralSource", "sourceOfLead", "subSourceOfLead", "whatsappNumber",
        )),
        ("propertyInterest", _struct(
            "purposeOfProperty", "budgetRange", "carpetAreaSqFtRange", "otherPreferences",
            "preferredFloor", "preferredUnitType", "propertyStatus",
        )),
        ("siteVisit", _struct("date", "time", "schedule", "modeOfVisit")),
        "siteVisitDate", "siteVisitTime", "siteVisitDoneCount", "startDateTime", "endDateTime",
        "totalMissedCalls", "totalUnreadMsgs", "stageChangedAt", "unitId", "unitNumber",
        "unitType", "callDuration", "visitDate", "visitOutcome", "qualificationReason",
        "qualifiedBy", "callStatus", "comment", "meetingNotes", "followUpRequired",
        "Direction", "CallFrom", "DialWhomNumber", "CallTo", "DialCallStatus", "CallType",
        "CallSid", ("Legs", ArrayType(_struct("onCallDuration", "status"))),
        "RecordingUrl", "StartTime", "EndTime", "callEventStatus", "EventType",
        ("callEnded", BooleanType()),
    )
