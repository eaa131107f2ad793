"""M3: lead 360 dimension - lead_flat x communication logs x projects x labels.

One row per lead x matching log (a lead without logs keeps one row).  Consumers
that need one row per lead must reduce it (see plans.engagement / plans.response).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.flags import (
    booked_date,
    booked_flag,
    lead_temperature,
    site_visit_completed,
    site_visit_scheduled,
)
from ..functions.text import normalize_phone
from ..operators.joins import left_join_one_to_many, left_join_salted, lookup, role_lookups, role_lookups_once

# ---- fixed values: output columns -------------------------------------------
# label columns, named as the tables that read the dimension expect them
LABEL_ENTITY = "sirrus_lead_entity_name"
LABEL_STATUS = "sirrus_lead_status"
LABEL_SUB_SOURCE = "sirrus_sub_source_of_lead"
LABEL_SOURCE = "sirrus_source_of_lead"

# lead side, (output name, lead_flat column)
LEAD_COLUMNS: list[tuple[str, str]] = [
    ("lead_flat_id", "_id"), ("orgId", "orgId"), ("leadId", "leadId"), ("isActive", "isActive"),
    ("createdAt", "createdAt"), ("createdBy", "createdBy"), ("creatorId", "creatorId"),
    ("projectId", "projectId"), ("siteVisit", "original_siteVisit_json"),
    ("updatedAt", "updatedAt"), ("updatedBy", "updatedBy"), ("assigneeId", "assigneeId"),
    ("background", "background"), ("leadStatus", "leadStatus"), ("followUpDate", "followUpDate"),
    ("followUpTime", "followUpTime"), ("nextFollowUp", "nextFollowUp"),
    ("callHyperLink", "callHyperLink"), ("chatHyperLink", "chatHyperLink"),
    ("latestComment", "latestComment"), ("nextSiteVisit", "nextSiteVisit"),
    ("stageChangedAt", "stageChangedAt"), ("totalUnreadMsgs", "totalUnreadMsgs"),
    ("propertyInterest", "propertyInterest"), ("totalMissedCalls", "totalMissedCalls"),
    ("assignmentHistory", "assignmentHistory"), ("dispositionCallSid", "dispositionCallSid"),
    ("leadCreationSource", "leadCreationSource"), ("siteVisitDoneCount", "siteVisitDoneCount"),
    ("conversionPropensity", "conversionPropensity"),
    ("leadStatusChangeReason", "leadStatusChangeReason"),
]
LEAD_PROFILE_COLUMNS = (
    "profile_sourceOfLead", "profile_subSourceOfLead", "profile_fullName", "profile_age",
    "profile_gender", "profile_currentLocation", "profile_alternateNumber", "profile_email",
    "profile_referralSource", "profile_agentName",
)
PROJECT_COLUMNS = ("projectName", "projectStatus", "projectLogo", "completionDate", "projectPublishStatus")

# log side, (communication-log column, output name); clashing names get _comm
COMM_COLUMNS: list[tuple[str, str]] = [
    ("_id", "communication_log_id"),
    ("leadId", "leadId_comm"),
    ("orgId", "orgId_comm"),
    ("projectId", "projectId_comm"),
    ("isActive", "isActive_comm"),
    ("createdAt", "createdAt_comm"),
    ("createdBy", "createdBy_comm"),
    ("updatedAt", "updatedAt_comm"),
    ("updatedBy", "updatedBy_comm"),
    ("assigneeId", "assigneeId_comm"),
    ("leadStatus", "leadStatus_comm"),
    ("prevStatus", "prevStatus_comm"),
    ("leadStatusChangeReason", "leadStatusChangeReason_comm"),
    ("latestComment", "latestComment_comm"),
    ("nextFollowUp", "nextFollowUp_comm"),
    ("nextSiteVisit", "nextSiteVisit_comm"),
    ("stageChangedAt", "stageChangedAt_comm"),
    ("totalMissedCalls", "totalMissedCalls_comm"),
    ("totalUnreadMsgs", "totalUnreadMsgs_comm"),
    ("logEventType", "logEventType"),
    ("prevAssigneeId", "prevAssigneeId"),
    ("payload__v", "payload__v"),
    ("payload_id", "payload_id"),
    ("agentId", "agentId"),
    ("payload_assigneeId", "payload_assigneeId"),
    ("payload_assignmentHistory", "payload_assignmentHistory"),
    ("background_annualIncome", "background_annualIncome"),
    ("background_assignedTo", "background_assignedTo"),
    ("background_currentLocation", "background_currentLocation"),
    ("background_fundingIsLoaned", "background_fundingIsLoaned"),
    ("background_occupation", "background_occupation"),
    ("background_possessionDate_month", "background_possessionDate_month"),
    ("background_possessionDate_year", "background_possessionDate_year"),
    ("background_qualification", "background_qualification"),
    ("background_workLocation", "background_workLocation"),
    ("bookingId", "bookingId"),
    ("buildingId", "buildingId"),
    ("buildingName", "buildingName"),
    ("cancelledReason", "cancelledReason"),
    ("coOwnerDetails", "coOwnerDetails"),
    ("conversion_description", "conversion_description"),
    ("conversion_interactionNumber", "conversion_interactionNumber"),
    ("conversion_probability", "conversion_probability"),
    ("conversion_breakdown_ability", "conversion_breakdown_ability"),
    ("conversion_breakdown_intent", "conversion_breakdown_intent"),
    ("conversion_breakdown_perception", "conversion_breakdown_perception"),
    ("conversion_breakdown_readiness", "conversion_breakdown_readiness"),
    ("pricing_agreementValue", "pricing_agreementValue"),
    ("pricing_modeOfPayment", "pricing_modeOfPayment"),
    ("pricing_tokenAmount", "pricing_tokenAmount"),
    ("profile_fullName", "profile_fullName_comm"),
    ("profile_email", "profile_email_comm"),
    ("profile_gender", "profile_gender_comm"),
    ("profile_age", "profile_age_comm"),
    ("profile_alternateNumber", "profile_alternateNumber_comm"),
    ("profile_countryCode", "profile_countryCode"),
    ("profile_referralSource", "profile_referralSource_comm"),
    ("profile_sourceOfLead", "profile_sourceOfLead_comm"),
    ("profile_subSourceOfLead", "profile_subSourceOfLead_comm"),
    ("propertyInterest_purposeOfProperty", "propertyInterest_purposeOfProperty"),
    ("propertyInterest_budgetRange", "propertyInterest_budgetRange"),
    ("propertyInterest_carpetAreaSqFtRange", "propertyInterest_carpetAreaSqFtRange"),
    ("propertyInterest_otherPreferences", "propertyInterest_otherPreferences"),
    ("propertyInterest_preferredFloor", "propertyInterest_preferredFloor"),
    ("propertyInterest_preferredUnitType", "propertyInterest_preferredUnitType"),
    ("propertyInterest_propertyStatus", "propertyInterest_propertyStatus"),
    ("siteVisit_date", "siteVisit_date"),
    ("siteVisit_modeOfVisit", "siteVisit_modeOfVisit"),
    ("siteVisit_schedule", "siteVisit_schedule"),
    ("siteVisit_time", "siteVisit_time"),
    ("siteVisitDate", "siteVisitDate"),
    ("siteVisitDoneCount", "siteVisitDoneCount_comm"),
    ("siteVisitTime", "siteVisitTime"),
    ("siteVisitstartDateTime", "siteVisitstartDateTime_comm"),
    ("siteVisitendDateTime", "siteVisitendDateTime_comm"),
    ("remarks", "remarks"),
    ("payload_status", "payload_status"),
    ("payload_subStatus", "payload_subStatus"),
    ("viewed", "viewed"),
    ("callDuration", "callDuration"),
    ("agentName", "agentName"),
    ("visitDate", "visitDate"),
    ("visitOutcome", "visitOutcome"),
    ("qualificationReason", "qualificationReason"),
    ("qualifiedBy", "qualifiedBy"),
    ("agentPhone", "agentPhone"),
    ("callStatus", "callStatus"),
    ("comment", "comment"),
    ("meetingNotes", "meetingNotes"),
    ("followUpRequired", "followUpRequired"),
    ("call_direction", "call_direction_comm"),
    ("call_from", "call_from_comm"),
    ("dial_whom_number", "dial_whom_number_comm"),
    ("call_to", "call_to_comm"),
    ("dial_call_status", "dial_call_status_comm"),
    ("call_type", "call_type_comm"),
    ("call_sid", "call_sid_comm"),
    ("call_legs", "call_legs_comm"),
    ("recording_url", "recording_url_comm"),
    ("call_start_time", "call_start_time_comm"),
    ("call_end_time", "call_end_time_comm"),
    ("call_event_status", "call_event_status_comm"),
    ("event_type", "event_type_comm"),
    ("call_ended", "call_ended_comm"),
]
DERIVED_COLUMNS = (
    "site_visit_scheduled", LABEL_ENTITY, LABEL_STATUS,
    "previous_lead_status", LABEL_SUB_SOURCE, LABEL_SOURCE,
    "booked_flag", "Site_Visit_Completed", "booked_date", "lead_temperature",
)
OUTPUT_COLUMNS = (
    [o for o, _ in LEAD_COLUMNS]
    + ["pms_LeadId", "profile_whatsAppNumber", "normalized_whatsapp_number"]
    + list(LEAD_PROFILE_COLUMNS)
    + list(PROJECT_COLUMNS)
    + [o for _, o in COMM_COLUMNS]
    + list(DERIVED_COLUMNS)
)


# keys of J1 as the two flat tables name them
LEAD_KEYS = ("_id", "orgId", "projectId")
LOG_KEYS = ("leadId", "orgId", "projectId")


def lead_side(
    lead_flat: DataFrame, projects: DataFrame, labels: DataFrame, labels_once: bool = False
) -> DataFrame:
    """The lead columns with their lookups: J2 (project) and J3 (status, sub-source and
    source labels), once per lead and not once per lead x log row.  ``labels_once``: the
    three label roles in one join (``role_lookups_once``)."""
    phone = F.col("profile_whatsAppNumber")
    leads = lead_flat.select(
        *[F.col(src).alias(out) for out, src in LEAD_COLUMNS],
        F.lit(None).cast("string").alias("pms_LeadId"),
        phone.alias("profile_whatsAppNumber"),
        normalize_phone(phone).alias("normalized_whatsapp_number"),
        *LEAD_PROFILE_COLUMNS,
        lead_temperature(F.col("conversionPropensity")).alias("lead_temperature"),
    )
    leads = lookup(
        leads, projects, on=[("projectId", "_id"), ("orgId", "orgId")],
        columns={c: c for c in PROJECT_COLUMNS}, role="project",
    )
    return (role_lookups_once if labels_once else role_lookups)(
        leads,
        labels,
        {
            "status": ([("leadStatus", "_id"), ("orgId", "orgId")],
                       {"entityName": LABEL_ENTITY, "labelName": LABEL_STATUS}),
            "subsource": ([("profile_subSourceOfLead", "_id"), ("orgId", "orgId")],
                          {"labelName": LABEL_SUB_SOURCE}),
            "source": ([("profile_sourceOfLead", "_id"), ("orgId", "orgId")],
                       {"labelName": LABEL_SOURCE}),
        },
    )


def log_side(logs: DataFrame, labels: DataFrame) -> DataFrame:
    """The logs with J4, the label of their previous status."""
    return lookup(
        logs, labels, on=[("prevStatus", "_id"), ("orgId", "orgId")],
        columns={"labelName": "previous_lead_status"}, role="prevstatus",
    )


def lead_360(
    lead_flat: DataFrame,
    logs: DataFrame,
    projects: DataFrame,
    labels: DataFrame,
) -> DataFrame:
    """M3 as one lazy plan: the lookups of both sides, then J1 as a left join.

    Every lookup is keyed by columns of one side only, so it is applied to that side
    before the one-to-many join; left lookups commute with the left join.  For leads
    with very many logs give ``join_sides`` their keys, as ``plans.jobs.lead_360_of`` does."""
    return join_sides(lead_side(lead_flat, projects, labels), log_side(logs, labels))


def join_sides(
    leads: DataFrame, logs: DataFrame, skew_safe: bool = False, hot: Sequence[tuple] | None = None
) -> DataFrame:
    """J1 (``lead_side`` x ``log_side`` on lead id, org and project), then E1-E5 and the
    163-column projection.  ``hot`` are the keys (lead, org, project) of leads with a large
    share of the logs, each with a log; with it every side is read once
    (``left_join_salted``).  ``skew_safe`` needs no such list and reads ``leads`` twice, so
    they should be a table by then."""
    on = [("lead_flat_id", "leadId"), ("orgId", "orgId"), ("projectId", "projectId")]
    right_columns = {**dict(COMM_COLUMNS), "previous_lead_status": "previous_lead_status"}
    if hot is not None:
        df = left_join_salted(leads, logs, on, right_columns, hot)
    else:
        df = left_join_one_to_many(leads, logs, on, right_columns, skew_safe=skew_safe)
    label = F.col(LABEL_STATUS)
    booking = F.col("bookingId")
    derived = {
        "site_visit_scheduled": site_visit_scheduled(
            F.col("siteVisit"), F.col("nextSiteVisit_comm"),
            F.col("siteVisit_date"), F.col("siteVisit_schedule"), F.col("siteVisit_time"),
            F.col("siteVisitDate"), F.col("siteVisitTime"),
        ),
        "booked_flag": booked_flag(booking, label),
        "Site_Visit_Completed": site_visit_completed(F.col("payload_subStatus")),
        "booked_date": booked_date(booking, label, F.col("createdAt_comm")),
    }
    return df.withColumns(derived).select(*OUTPUT_COLUMNS)


assert len(OUTPUT_COLUMNS) == len(set(OUTPUT_COLUMNS)) == 163, len(OUTPUT_COLUMNS)
