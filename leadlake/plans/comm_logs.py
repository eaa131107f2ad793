"""M2: bronze communication log with a ``payload`` JSON column -> 109 flat columns.

Despite the historical table name ("exploded") no array is exploded: arrays are
carried as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.schemas import payload_schema
from ..operators.flatten import project_paths
from ..operators.guards import parse_or_null


# ---- fixed values: (output column, payload path), in output order ------------
OUTPUT_SPEC: list[tuple[str, str]] = [
    ("_id", "_id"),
    ("orgId", "orgId"),
    ("leadId", "leadId"),
    ("isActive", "payload.isActive"),
    ("createdAt", "payload.createdAt"),
    ("createdBy", "payload.createdBy"),
    ("projectId", "payload.projectId"),
    ("updatedAt", "payload.updatedAt"),
    ("updatedBy", "payload.updatedBy"),
    ("assigneeId", "payload.assigneeId"),
    ("leadStatus", "payload.leadStatus"),
    ("prevAssigneeId", "payload.prevAssigneeId"),
    ("leadStatusChangeReason", "payload.leadStatusChangeReason"),
    ("logEventType", "payload.logEventType"),
    ("prevStatus", "payload.prevStatus"),
    ("payload__v", "payload.__v"),
    ("payload_id", "payload._id"),
    ("agentId", "payload.agentId"),
    ("payload_assigneeId", "payload.assigneeId"),
    ("payload_assignmentHistory", "payload.assignmentHistory"),
    ("background_annualIncome", "payload.background.annualIncome"),
    ("background_assignedTo", "payload.background.assignedTo"),
    ("background_currentLocation", "payload.background.currentLocation"),
    ("background_fundingIsLoaned", "payload.background.fundingIsLoaned"),
    ("background_occupation", "payload.background.occupation"),
    ("background_possessionDate_month", "payload.background.possessionDate.month"),
    ("background_possessionDate_year", "payload.background.possessionDate.year"),
    ("background_qualification", "payload.background.qualification"),
    ("background_workLocation", "payload.background.workLocation"),
    ("bookingId", "payload.bookingId"),
    ("buildingId", "payload.buildingId"),
    ("buildingName", "payload.buildingName"),
    ("cancelledReason", "payload.cancelledReason"),
    ("chatHyperLink", "payload.chatHyperLink"),
    ("coOwnerDetails", "payload.coOwnerDetails"),
    ("conversion_description", "payload.conversionPropensity.description"),
    ("conversion_interactionNumber", "payload.conversionPropensity.interactionNumber"),
    ("conversion_probability", "payload.conversionPropensity.probability"),
    ("conversion_breakdown_ability", "payload.conversionPropensity.breakdown.ability"),
    ("conversion_breakdown_intent", "payload.conversionPropensity.breakdown.intent"),
    ("conversion_breakdown_perception", "payload.conversionPropensity.breakdown.perception"),
    ("conversion_breakdown_readiness", "payload.conversionPropensity.breakdown.readiness"),
    ("pricing_agreementValue", "payload.pricingDetails.agreementValue"),
    ("pricing_modeOfPayment", "payload.pricingDetails.modeOfPayment"),
    ("pricing_tokenAmount", "payload.pricingDetails.tokenAmount"),
    ("profile_fullName", "payload.profile.fullName"),
    ("profile_email", "payload.profile.email"),
    ("profile_gender", "payload.profile.gender"),
    ("profile_age", "payload.profile.age"),
    ("profile_alternateNumber", "payload.profile.alternateNumber"),
    ("profile_countryCode", "payload.profile.countryCode"),
    ("profile_referralSource", "payload.profile.referralSource"),
    ("profile_sourceOfLead", "payload.profile.sourceOfLead"),
    ("profile_subSourceOfLead", "payload.profile.subSourceOfLead"),
    ("whatsAppNumber", "payload.profile.whatsappNumber"),
    ("propertyInterest_purposeOfProperty", "payload.propertyInterest.purposeOfProperty"),
    ("propertyInterest_budgetRange", "payload.propertyInterest.budgetRange"),
    ("propertyInterest_carpetAreaSqFtRange", "payload.propertyInterest.carpetAreaSqFtRange"),
    ("propertyInterest_otherPreferences", "payload.propertyInterest.otherPreferences"),
    ("propertyInterest_preferredFloor", "payload.propertyInterest.preferredFloor"),
    ("propertyInterest_preferredUnitType", "payload.propertyInterest.preferredUnitType"),
    ("propertyInterest_propertyStatus", "payload.propertyInterest.propertyStatus"),
    ("siteVisit_date", "payload.siteVisit.date"),
    ("siteVisit_modeOfVisit", "payload.siteVisit.modeOfVisit"),
    ("siteVisit_schedule", "payload.siteVisit.schedule"),
    ("siteVisit_time", "payload.siteVisit.time"),
    ("siteVisitDate", "payload.siteVisitDate"),
    ("siteVisitDoneCount", "payload.siteVisitDoneCount"),
    ("siteVisitTime", "payload.siteVisitTime"),
    ("siteVisitstartDateTime", "payload.startDateTime"),
    ("siteVisitendDateTime", "payload.endDateTime"),
    ("latestComment", "payload.latestComment"),
    ("nextFollowUp", "payload.nextFollowUp"),
    ("nextSiteVisit", "payload.nextSiteVisit"),
    ("stageChangedAt", "payload.stageChangedAt"),
    ("totalMissedCalls", "payload.totalMissedCalls"),
    ("totalUnreadMsgs", "payload.totalUnreadMsgs"),
    ("unitId", "payload.unitId"),
    ("unitNumber", "payload.unitNumber"),
    ("unitType", "payload.unitType"),
    ("remarks", "payload.remarks"),
    ("payload_status", "payload.status"),
    ("payload_subStatus", "payload.subStatus"),
    ("viewed", "payload.viewed"),
    ("callDuration", "payload.callDuration"),
    ("agentName", "payload.agentName"),
    ("visitDate", "payload.visitDate"),
    ("visitOutcome", "payload.visitOutcome"),
    ("qualificationReason", "payload.qualificationReason"),
    ("qualifiedBy", "payload.qualifiedBy"),
    ("agentPhone", "payload.agentPhone"),
    ("callStatus", "payload.callStatus"),
    ("comment", "payload.comment"),
    ("meetingNotes", "payload.meetingNotes"),
    ("followUpRequired", "payload.followUpRequired"),
    ("call_direction", "payload.Direction"),
    ("call_from", "payload.CallFrom"),
    ("dial_whom_number", "payload.DialWhomNumber"),
    ("call_to", "payload.CallTo"),
    ("dial_call_status", "payload.DialCallStatus"),
    ("call_type", "payload.CallType"),
    ("call_sid", "payload.CallSid"),
    ("call_legs", "payload.Legs"),
    ("recording_url", "payload.RecordingUrl"),
    ("call_start_time", "payload.StartTime"),
    ("call_end_time", "payload.EndTime"),
    ("call_event_status", "payload.callEventStatus"),
    ("event_type", "payload.EventType"),
    ("call_ended", "payload.callEnded"),
]


def communication_logs_flat(bronze: DataFrame) -> DataFrame:
    """``_id``, ``orgId`` and ``leadId`` are required; ``payload`` is optional."""
    df = parse_or_null(bronze, "payload", payload_schema())
    return project_paths(df, OUTPUT_SPEC)


def _check() -> None:  # pragma: no cover - import-time sanity of the spec
    names = [n for n, _ in OUTPUT_SPEC]
    assert len(names) == len(set(names)) == 109, len(names)


_check()
