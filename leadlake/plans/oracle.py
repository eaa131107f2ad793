"""DuckDB SQL equivalents of ``plans.catalogue`` (the correctness oracle).

The derivation rules of ``plans.testbed`` are restated here in SQL, and each
query is written the straightforward way (left joins as left joins, the funnel
with COUNT(DISTINCT ...), the pivot with FILTER clauses) so the check is
independent of the Spark formulation.  Local time is UTC + 5:30 (no DST).
"""

from __future__ import annotations

from collections.abc import Sequence

from . import testbed as T

LOCAL = "INTERVAL 330 MINUTE"

# ---- fixed values, restated here so that a wrong list in the library shows up ---------
# (event, case folding, statuses); first match wins
Rules = list[tuple[str, str, tuple[str, ...]]]
WHATSAPP_ENGAGEMENT: Rules = [
    ("read", "lower", ("read", "seen", "message_read")),
    ("click", "lower", ("click", "url_click")),
    ("delivered", "lower", ("delivered", "deliv")),
]
WHATSAPP_RESPONSE: Rules = [
    ("sent", "upper", ("QUEUED", "SENT")),
    ("delivered", "lower", ("delivered", "deliv")),
    ("read", "lower", ("read", "seen", "message_read")),
    ("click", "lower", ("click", "url_click")),
    ("failed", "lower", ("failed",)),
    ("reply", "lower", ("reply", "replied")),
]
SMS_RESPONSE: Rules = [
    ("sent", "upper", ("SENT", "SUBMITD", "DELIVRD", "DLT HEADER FILTER", "DLT TEMPLATE FILTER", "DLT VL FAILURE",
                       "EXP-ABS-SUB", "EXP-NW-FAIL", "EXPIRED", "FAILED", "INVALID REQUEST")),
    ("failed", "upper", ("FAILED", "UNDELIV")),
    ("click", "lower", ("click",)),
]
SMS_RESPONSE_CORRECTED: Rules = [
    ("delivered", "upper", ("DELIVRD",)),
    ("failed", "upper", ("FAILED", "UNDELIV")),
    ("sent", "upper", ("SENT", "SUBMITD", "DLT HEADER FILTER", "DLT TEMPLATE FILTER", "DLT VL FAILURE",
                       "EXP-ABS-SUB", "EXP-NW-FAIL", "EXPIRED", "INVALID REQUEST")),
    ("click", "lower", ("click",)),
]
EMAIL_RESPONSE: Rules = [
    ("sent", "upper", ("PROCESSED", "DROPPED", "BOUNCED", "REJECTED", "SENT")),
    ("delivered", "lower", ("delivered",)),
    ("open", "lower", ("open", "opened")),
    ("click", "lower", ("click", "clicked")),
    ("spam", "lower", ("spam",)),
    ("unsubscribe", "lower", ("unsubscribe", "unsubscribed")),
]
PASSTHROUGH = "lower-cased status"
# M1, output columns
LEAD_FLAT = """
_id orgId leadId isActive createdAt createdBy creatorId projectId updatedAt updatedBy assigneeId
leadStatus leadStatusChangeReason background followUpDate followUpTime nextFollowUp callHyperLink
chatHyperLink latestComment nextSiteVisit stageChangedAt totalUnreadMsgs totalMissedCalls
assignmentHistory dispositionCallSid leadCreationSource siteVisitDoneCount original_siteVisit_json
propertyInterest conversionPropensity profile profile_fullName profile_email profile_age
profile_gender profile_currentLocation profile_alternateNumber profile_whatsAppNumber
profile_sourceOfLead profile_subSourceOfLead profile_referralSource profile_agentName
propertyInterest_budgetRange propertyInterest_carpetAreaSqFtRange propertyInterest_preferredFloor
propertyInterest_preferredUnitType propertyInterest_purposeOfProperty
propertyInterest_propertyStatus propertyInterest_otherPreferences conversionPropensity_probability
conversionPropensity_leadIntent siteVisit_date siteVisit_time siteVisit_schedule
siteVisit_modeOfVisit
""".split()
# M2, output column = payload path where the two differ (@ column: outside the payload)
COMM_LOGS = """
_id=@_id orgId=@orgId leadId=@leadId isActive createdAt createdBy projectId updatedAt updatedBy
assigneeId leadStatus prevAssigneeId leadStatusChangeReason logEventType prevStatus payload__v=__v
payload_id=_id agentId payload_assigneeId=assigneeId payload_assignmentHistory=assignmentHistory
background_annualIncome=background.annualIncome background_assignedTo=background.assignedTo
background_currentLocation=background.currentLocation
background_fundingIsLoaned=background.fundingIsLoaned background_occupation=background.occupation
background_possessionDate_month=background.possessionDate.month
background_possessionDate_year=background.possessionDate.year
background_qualification=background.qualification background_workLocation=background.workLocation
bookingId buildingId buildingName cancelledReason chatHyperLink coOwnerDetails
conversion_description=conversionPropensity.description
conversion_interactionNumber=conversionPropensity.interactionNumber
conversion_probability=conversionPropensity.probability
conversion_breakdown_ability=conversionPropensity.breakdown.ability
conversion_breakdown_intent=conversionPropensity.breakdown.intent
conversion_breakdown_perception=conversionPropensity.breakdown.perception
conversion_breakdown_readiness=conversionPropensity.breakdown.readiness
pricing_agreementValue=pricingDetails.agreementValue
pricing_modeOfPayment=pricingDetails.modeOfPayment pricing_tokenAmount=pricingDetails.tokenAmount
profile_fullName=profile.fullName profile_email=profile.email profile_gender=profile.gender
profile_age=profile.age profile_alternateNumber=profile.alternateNumber
profile_countryCode=profile.countryCode profile_referralSource=profile.referralSource
profile_sourceOfLead=profile.sourceOfLead profile_subSourceOfLead=profile.subSourceOfLead
whatsAppNumber=profile.whatsappNumber
propertyInterest_purposeOfProperty=propertyInterest.purposeOfProperty
propertyInterest_budgetRange=propertyInterest.budgetRange
propertyInterest_carpetAreaSqFtRange=propertyInterest.carpetAreaSqFtRange
propertyInterest_otherPreferences=propertyInterest.otherPreferences
propertyInterest_preferredFloor=propertyInterest.preferredFloor
propertyInterest_preferredUnitType=propertyInterest.preferredUnitType
propertyInterest_propertyStatus=propertyInterest.propertyStatus siteVisit_date=siteVisit.date
siteVisit_modeOfVisit=siteVisit.modeOfVisit siteVisit_schedule=siteVisit.schedule
siteVisit_time=siteVisit.time siteVisitDate siteVisitDoneCount siteVisitTime
siteVisitstartDateTime=startDateTime siteVisitendDateTime=endDateTime latestComment nextFollowUp
nextSiteVisit stageChangedAt totalMissedCalls totalUnreadMsgs unitId unitNumber unitType remarks
payload_status=status payload_subStatus=subStatus viewed callDuration agentName visitDate
visitOutcome qualificationReason qualifiedBy agentPhone callStatus comment meetingNotes
followUpRequired call_direction=Direction call_from=CallFrom dial_whom_number=DialWhomNumber
call_to=CallTo dial_call_status=DialCallStatus call_type=CallType call_sid=CallSid call_legs=Legs
recording_url=RecordingUrl call_start_time=StartTime call_end_time=EndTime
call_event_status=callEventStatus event_type=EventType call_ended=callEnded
""".split()
# M3, output column = side.column; the columns without a side are written out below
LEAD_360 = """
lead_flat_id=lf._id orgId=lf.orgId leadId=lf.leadId isActive=lf.isActive createdAt=lf.createdAt
createdBy=lf.createdBy creatorId=lf.creatorId projectId=lf.projectId
siteVisit=lf.original_siteVisit_json updatedAt=lf.updatedAt updatedBy=lf.updatedBy
assigneeId=lf.assigneeId background=lf.background leadStatus=lf.leadStatus
followUpDate=lf.followUpDate followUpTime=lf.followUpTime nextFollowUp=lf.nextFollowUp
callHyperLink=lf.callHyperLink chatHyperLink=lf.chatHyperLink latestComment=lf.latestComment
nextSiteVisit=lf.nextSiteVisit stageChangedAt=lf.stageChangedAt totalUnreadMsgs=lf.totalUnreadMsgs
propertyInterest=lf.propertyInterest totalMissedCalls=lf.totalMissedCalls
assignmentHistory=lf.assignmentHistory dispositionCallSid=lf.dispositionCallSid
leadCreationSource=lf.leadCreationSource siteVisitDoneCount=lf.siteVisitDoneCount
conversionPropensity=lf.conversionPropensity leadStatusChangeReason=lf.leadStatusChangeReason
pms_LeadId profile_whatsAppNumber=lf.profile_whatsAppNumber normalized_whatsapp_number
profile_sourceOfLead=lf.profile_sourceOfLead profile_subSourceOfLead=lf.profile_subSourceOfLead
profile_fullName=lf.profile_fullName profile_age=lf.profile_age profile_gender=lf.profile_gender
profile_currentLocation=lf.profile_currentLocation
profile_alternateNumber=lf.profile_alternateNumber profile_email=lf.profile_email
profile_referralSource=lf.profile_referralSource profile_agentName=lf.profile_agentName
projectName=p.projectName projectStatus=p.projectStatus projectLogo=p.projectLogo
completionDate=p.completionDate projectPublishStatus=p.projectPublishStatus
communication_log_id=lg._id leadId_comm=lg.leadId orgId_comm=lg.orgId projectId_comm=lg.projectId
isActive_comm=lg.isActive createdAt_comm=lg.createdAt createdBy_comm=lg.createdBy
updatedAt_comm=lg.updatedAt updatedBy_comm=lg.updatedBy assigneeId_comm=lg.assigneeId
leadStatus_comm=lg.leadStatus prevStatus_comm=lg.prevStatus
leadStatusChangeReason_comm=lg.leadStatusChangeReason latestComment_comm=lg.latestComment
nextFollowUp_comm=lg.nextFollowUp nextSiteVisit_comm=lg.nextSiteVisit
stageChangedAt_comm=lg.stageChangedAt totalMissedCalls_comm=lg.totalMissedCalls
totalUnreadMsgs_comm=lg.totalUnreadMsgs logEventType=lg.logEventType
prevAssigneeId=lg.prevAssigneeId payload__v=lg.payload__v payload_id=lg.payload_id
agentId=lg.agentId payload_assigneeId=lg.payload_assigneeId
payload_assignmentHistory=lg.payload_assignmentHistory
background_annualIncome=lg.background_annualIncome background_assignedTo=lg.background_assignedTo
background_currentLocation=lg.background_currentLocation
background_fundingIsLoaned=lg.background_fundingIsLoaned
background_occupation=lg.background_occupation
background_possessionDate_month=lg.background_possessionDate_month
background_possessionDate_year=lg.background_possessionDate_year
background_qualification=lg.background_qualification
background_workLocation=lg.background_workLocation bookingId=lg.bookingId buildingId=lg.buildingId
buildingName=lg.buildingName cancelledReason=lg.cancelledReason coOwnerDetails=lg.coOwnerDetails
conversion_description=lg.conversion_description
conversion_interactionNumber=lg.conversion_interactionNumber
conversion_probability=lg.conversion_probability
conversion_breakdown_ability=lg.conversion_breakdown_ability
conversion_breakdown_intent=lg.conversion_breakdown_intent
conversion_breakdown_perception=lg.conversion_breakdown_perception
conversion_breakdown_readiness=lg.conversion_breakdown_readiness
pricing_agreementValue=lg.pricing_agreementValue pricing_modeOfPayment=lg.pricing_modeOfPayment
pricing_tokenAmount=lg.pricing_tokenAmount profile_fullName_comm=lg.profile_fullName
profile_email_comm=lg.profile_email profile_gender_comm=lg.profile_gender
profile_age_comm=lg.profile_age profile_alternateNumber_comm=lg.profile_alternateNumber
profile_countryCode=lg.profile_countryCode profile_referralSource_comm=lg.profile_referralSource
profile_sourceOfLead_comm=lg.profile_sourceOfLead
profile_subSourceOfLead_comm=lg.profile_subSourceOfLead
propertyInterest_purposeOfProperty=lg.propertyInterest_purposeOfProperty
propertyInterest_budgetRange=lg.propertyInterest_budgetRange
propertyInterest_carpetAreaSqFtRange=lg.propertyInterest_carpetAreaSqFtRange
propertyInterest_otherPreferences=lg.propertyInterest_otherPreferences
propertyInterest_preferredFloor=lg.propertyInterest_preferredFloor
propertyInterest_preferredUnitType=lg.propertyInterest_preferredUnitType
propertyInterest_propertyStatus=lg.propertyInterest_propertyStatus siteVisit_date=lg.siteVisit_date
siteVisit_modeOfVisit=lg.siteVisit_modeOfVisit siteVisit_schedule=lg.siteVisit_schedule
siteVisit_time=lg.siteVisit_time siteVisitDate=lg.siteVisitDate
siteVisitDoneCount_comm=lg.siteVisitDoneCount siteVisitTime=lg.siteVisitTime
siteVisitstartDateTime_comm=lg.siteVisitstartDateTime
siteVisitendDateTime_comm=lg.siteVisitendDateTime remarks=lg.remarks
payload_status=lg.payload_status payload_subStatus=lg.payload_subStatus viewed=lg.viewed
callDuration=lg.callDuration agentName=lg.agentName visitDate=lg.visitDate
visitOutcome=lg.visitOutcome qualificationReason=lg.qualificationReason qualifiedBy=lg.qualifiedBy
agentPhone=lg.agentPhone callStatus=lg.callStatus comment=lg.comment meetingNotes=lg.meetingNotes
followUpRequired=lg.followUpRequired call_direction_comm=lg.call_direction
call_from_comm=lg.call_from dial_whom_number_comm=lg.dial_whom_number call_to_comm=lg.call_to
dial_call_status_comm=lg.dial_call_status call_type_comm=lg.call_type call_sid_comm=lg.call_sid
call_legs_comm=lg.call_legs recording_url_comm=lg.recording_url
call_start_time_comm=lg.call_start_time call_end_time_comm=lg.call_end_time
call_event_status_comm=lg.call_event_status event_type_comm=lg.event_type
call_ended_comm=lg.call_ended site_visit_scheduled sirrus_lead_entity_name sirrus_lead_status
previous_lead_status sirrus_sub_source_of_lead sirrus_source_of_lead booked_flag
Site_Visit_Completed booked_date lead_temperature
""".split()


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def org(x: str) -> str:
    return f"('org' || CAST(({x}) % 3 AS VARCHAR))"


def project(x: str) -> str:
    return f"('P' || CAST(({x}) % 7 AS VARCHAR))"


def base(x: str) -> str:
    return f"CAST(9000000000 + ({x}) AS VARCHAR)"


def phone_text(x: str) -> str:
    b = base(x)
    return (
        f"(CASE ({x}) % 8 WHEN 0 THEN '+91 ' || {b} WHEN 1 THEN '91' || {b} "
        f"WHEN 2 THEN '+91' || substring({b}, 1, 4) "
        f"WHEN 3 THEN '91' || substring({b}, 3, 3) || '-' || substring({b}, 6, 5) "
        f"WHEN 4 THEN '+1 ' || substring({b}, 1, 3) || ' ' || substring({b}, 4, 3) || ' ' || substring({b}, 7, 4) "
        f"WHEN 5 THEN substring({b}, 1, 5) || ' ' || substring({b}, 6, 5) "
        f"WHEN 6 THEN '' ELSE NULL END)"
    )


def digits(x: str) -> str:
    return f"regexp_replace(CAST({x} AS VARCHAR), '[^0-9]', '', 'g')"


def phone_key(x: str) -> str:
    d = digits(x)
    return (f"(CASE WHEN {d} = '' THEN NULL WHEN length({d}) > 10 AND starts_with({d}, '91') "
            f"THEN substring({d}, 3) ELSE {d} END)")


def normalize_phone(x: str) -> str:
    d = digits(x)
    return (f"(CASE WHEN {x} IS NULL THEN NULL "
            f"WHEN starts_with({d}, '91') AND length({x}) > 10 THEN substring({d}, 3) "
            f"WHEN starts_with({x}, '+91') THEN substring({x}, 4) "
            f"WHEN starts_with({x}, '+') THEN substring({x}, 2) ELSE {x} END)")


def present(x: str) -> str:
    return f"({x} IS NOT NULL AND regexp_replace({x}, '\\s+', '', 'g') <> '' AND {x} <> 'None')"


def pick(vocab: Sequence[str], k: str) -> str:
    return f"list_value({', '.join(_q(v) for v in vocab)})[(({k}) % {len(vocab)}) + 1]"


def case_map(x: str, rules: Rules, default: str | None = None) -> str:
    parts = []
    for event, fold, values in rules:
        parts.append(f"WHEN {fold}({x}) IN ({', '.join(_q(v) for v in values)}) THEN {_q(event)}")
    tail = ""
    if default == PASSTHROUGH:
        tail = f" ELSE lower({x})"
    elif default is not None:
        tail = f" ELSE {_q(default)}"
    return f"(CASE {' '.join(parts)}{tail} END)"


def booked(booking: str, label: str) -> str:
    return f"({booking} IS NOT NULL AND lower({label}) = 'booked')"


# ---- derived inputs ----------------------------------------------------------------
LEAD_DIM = f"""
SELECT CAST(c_custkey AS VARCHAR) AS lead_flat_id, 'L' || CAST(c_custkey AS VARCHAR) AS leadId,
       {org('c_custkey')} AS orgId, {phone_text('c_custkey')} AS phone,
       CASE WHEN o_orderpriority = '1-URGENT' THEN TRUE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL
            ELSE c_acctbal > 8000 END AS site_visit_scheduled,
       CASE WHEN o_orderstatus = 'F' AND c_acctbal > 5000
            THEN '2024-02-' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') END AS siteVisit_date,
       CASE WHEN o_orderstatus = 'O' THEN 'B' || CAST(o_orderkey AS VARCHAR) END AS bookingId,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Booked' WHEN 'MACHINERY' THEN 'BOOKED' ELSE c_mktsegment END AS label,
       CASE WHEN o_orderkey % 9 = 0 THEN '1m 20s' WHEN o_orderkey % 3 = 1 THEN '0' END AS callDuration,
       CASE WHEN o_orderkey % 32 = 0 THEN 'Answered' WHEN o_orderkey % 4 = 1 THEN 'no-answer' END AS callStatus
FROM customer LEFT JOIN orders ON c_custkey = o_custkey"""


def connected(duration: str, status: str) -> str:
    return (f"(CASE WHEN coalesce(TRY_CAST(regexp_replace(coalesce({duration}, '0'), '[^0-9.]', '', 'g') AS DOUBLE) > 0, FALSE) "
            f"OR lower(coalesce({status}, '')) IN ('connected', 'answered', 'completed', 'in-progress') THEN 1 ELSE 0 END)")


SMS_CODE = "CASE event_id % 4 WHEN 0 THEN '200' WHEN 1 THEN '500' WHEN 2 THEN '404' END"
SMS_DESC = "CASE event_id % 4 WHEN 0 THEN 'OK' WHEN 1 THEN 'Message Accepted' WHEN 2 THEN 'failed' END"
SMS_TYPE = "CASE event_id % 5 WHEN 0 THEN 'DELIVERY' WHEN 1 THEN 'Delivered' WHEN 2 THEN 'submit' END"
SMS_ENGAGEMENT = (f"(CASE WHEN ({SMS_CODE}) = '200' OR lower({SMS_DESC}) LIKE '%accept%' "
                  f"OR lower({SMS_TYPE}) IN ('delivered', 'delivery') THEN 'delivered' ELSE 'other' END)")


def _in(values: Sequence[str]) -> str:
    return ", ".join(_q(v) for v in values)


RESPONSE_EVENTS = f"""
SELECT CAST(ts + {LOCAL} AS DATE) AS event_date, {org('user_id')} AS orgId, {project('user_id')} AS projectId,
       CAST(user_id AS VARCHAR) AS profileId, {case_map(pick(T.SMS_STATUSES, 'event_id'), SMS_RESPONSE)} AS ev, 'sms' AS channel
FROM events WHERE event_type IN ({_in(T.SMS_EVENT_TYPES)})
UNION ALL
SELECT CAST(ts + {LOCAL} AS DATE), {org('user_id')}, {project('user_id')}, CAST(user_id AS VARCHAR),
       {case_map(pick(T.WHATSAPP_STATUSES, 'event_id'), WHATSAPP_RESPONSE)}, 'whatsapp'
FROM events WHERE event_type IN ({_in(T.WHATSAPP_EVENT_TYPES)})
UNION ALL
SELECT CAST(ts + {LOCAL} AS DATE), {org('user_id')}, CAST(NULL AS VARCHAR), CAST(user_id AS VARCHAR),
       {case_map(pick(T.EMAIL_STATUSES, 'event_id'), EMAIL_RESPONSE)}, 'email'
FROM events WHERE event_type IN ({_in(T.EMAIL_EVENT_TYPES)})"""

# (output, channel, event) - restated, not imported, so a wrong column list shows up
PIVOT_COLUMNS = [
    ("EMAIL_SENT", "email", "sent"), ("EMAIL_DELIVERED", "email", "delivered"),
    ("EMAIL_OPENED", "email", "open"), ("EMAIL_CLICKED", "email", "click"),
    ("EMAIL_SPAM", "email", "spam"), ("EMAIL_UNSUBSCRIBED", "email", "unsubscribe"),
    ("WHATSAPP_SENT", "whatsapp", "sent"), ("WHATSAPP_DELIVERED", "whatsapp", "delivered"),
    ("WHATSAPP_READ", "whatsapp", "read"), ("WHATSAPP_CLICKED", "whatsapp", "click"),
    ("WHATSAPP_FAILED", "whatsapp", "failed"), ("WHATSAPP_REPLIED", "whatsapp", "reply"),
    ("SMS_SENT", "sms", "sent"), ("SMS_DELIVERED", "sms", "delivered"),
    ("SMS_FAILED", "sms", "failed"), ("SMS_CLICKED", "sms", "click"),
]
PIVOT_AGGS = ",\n       ".join(
    f"CAST(sum(CASE WHEN ev = '{e}' THEN 1 ELSE 0 END) FILTER (WHERE channel = '{c}') AS BIGINT) AS {o}"
    for o, c, e in PIVOT_COLUMNS
)
PIVOT = f"""
SELECT event_date, orgId, projectId, profileId,
       {PIVOT_AGGS}
FROM ({RESPONSE_EVENTS}) GROUP BY event_date, orgId, projectId, profileId"""

WA_ROWS = f"""
SELECT user_id, json_extract_string(props, '$.k') AS campaignid,
       {case_map(pick(T.WHATSAPP_STATUSES, 'event_id'), WHATSAPP_ENGAGEMENT, PASSTHROUGH)} AS canonical_event,
       ts + {LOCAL} AS event_ts_local, value > 50 AS high_value, event_type
FROM events"""

def filler(name: str, k: str) -> str:
    return f"('{name}:' || CAST({k} % 11 AS VARCHAR))"


def json_object(fields: dict[str, str]) -> str:
    """JSON text of string fields; a NULL field is left out."""
    parts = [f"coalesce('\"{name}\":\"' || {value} || '\",', '')" for name, value in fields.items()]
    return "('{' || rtrim(" + " || ".join(parts) + ", ',') || '}')"


_K = "c_custkey"
_VISIT = {
    "date": "('2024-02-' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0'))", "time": filler("time", _K),
    "schedule": filler("schedule", _K), "modeOfVisit": "c_mktsegment",
}
_PROFILE = {
    "fullName": "c_name", "email": filler("email", _K), "age": "CAST(c_custkey % 60 + 20 AS VARCHAR)",
    "gender": filler("gender", _K), "currentLocation": filler("currentLocation", _K),
    "alternateNumber": filler("alternateNumber", _K), "whatsAppNumber": phone_text(_K),
    "sourceOfLead": "('S' || CAST((c_nationkey + 1) % 25 AS VARCHAR))",
    "subSourceOfLead": "('S' || CAST((c_nationkey + 3) % 25 AS VARCHAR))",
    "referralSource": filler("referralSource", _K), "agentName": filler("agentName", _K),
    "additionalInfo": filler("additionalInfo", _K),
}
_INTEREST = {f: filler(f, _K) for f in (
    "budgetRange", "carpetAreaSqFtRange", "preferredFloor", "preferredUnitType", "purposeOfProperty",
    "propertyStatus", "otherPreferences")}
_CONVERSION = {
    "description": filler("description", _K), "probability": filler("probability", _K),
    "interactionNumber": filler("interactionNumber", _K), "leadIntent": "c_mktsegment",
}
# the age is a JSON number
_PROFILE_JSON = f"regexp_replace({json_object(_PROFILE)}, '\"age\":\"([0-9]+)\"', '\"age\":\\1')"
_LEAD = {
    "_id": "CAST(c_custkey AS VARCHAR)", "orgId": org(_K), "leadId": "('L' || CAST(c_custkey AS VARCHAR))",
    "projectId": project(_K), "leadStatus": "('S' || CAST(c_nationkey AS VARCHAR))",
    "isActive": "CAST(c_acctbal > 0 AS VARCHAR)",
    "original_siteVisit_json": f"(CASE c_custkey % 4 WHEN 1 THEN '  ' WHEN 2 THEN {json_object(_VISIT)} WHEN 3 THEN 'None' END)",
    "propertyInterest": json_object(_INTEREST), "conversionPropensity": json_object(_CONVERSION),
    "profile": _PROFILE_JSON,
    **{f"profile_{f}": v for f, v in _PROFILE.items()},
    **{f"propertyInterest_{f}": v for f, v in _INTEREST.items()},
    **{f"conversionPropensity_{f}": v for f, v in _CONVERSION.items()},
    **{f"siteVisit_{f}": f"(CASE WHEN c_custkey % 4 = 2 THEN {v} END)" for f, v in _VISIT.items()},
}
LEADS_FLAT = "SELECT " + ",\n       ".join(
    f"{_LEAD.get(c, filler(c, _K))} AS {c}" for c in LEAD_FLAT) + "\nFROM customer"

_O = "o_orderkey"
_PAYLOAD = {
    "projectId": f"(CASE WHEN o_orderpriority <> '5-LOW' THEN {project('o_custkey')} END)",
    "prevStatus": "('S' || CAST(o_orderkey % 25 AS VARCHAR))",
    "bookingId": "(CASE WHEN o_orderstatus = 'F' THEN 'B' || CAST(o_orderkey AS VARCHAR) END)",
    "subStatus": "(CASE WHEN o_orderpriority = '1-URGENT' THEN 'SV_DONE' END)",
    "createdAt": "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)",
    "nextSiteVisit": "(CASE o_orderkey % 3 WHEN 0 THEN 'None' WHEN 1 THEN '2024-03-01' END)",
    "siteVisit.date": "(CASE WHEN o_orderstatus = 'O' THEN '2024-04-01' END)",
    **{f: f"(CASE WHEN o_orderkey % 4 = 3 THEN {filler(f, _O)} END)"
       for f in ("siteVisit.time", "siteVisit.schedule", "siteVisitDate", "siteVisitTime")},
    "callDuration": "(CASE o_orderkey % 3 WHEN 0 THEN '1m 20s' WHEN 1 THEN '0' END)",
    "callStatus": "(CASE WHEN o_orderpriority = '2-HIGH' THEN 'answered' END)",
    "viewed": "(o_orderstatus = 'P')",
    "callEnded": "(o_orderkey % 2 = 0)",
    "assignmentHistory": f"('[\"' || {filler('first', _O)} || '\",\"' || {filler('then', 'o_custkey')} || '\"]')",
    "Legs": "('[' || " + json_object({"onCallDuration": filler("duration", _O), "status": filler("leg", _O)}) + " || ']')",
    "@_id": "CAST(o_orderkey AS VARCHAR)", "@orgId": org("o_custkey"), "@leadId": "CAST(o_custkey AS VARCHAR)",
}


def _pair(item: str) -> tuple[str, str]:
    name, _, source = item.partition("=")
    return name, source or name


LOGS_FLAT = "SELECT " + ",\n       ".join(
    f"{_PAYLOAD.get(path, filler(path, _O))} AS {name}" for name, path in map(_pair, COMM_LOGS)) + "\nFROM orders"

PROJECTS = (f"SELECT 'P' || CAST(r_regionkey AS VARCHAR) AS _id, {org('r_regionkey')} AS orgId, r_name AS projectName, "
            f"'active' AS projectStatus, 'logo' || CAST(r_regionkey AS VARCHAR) AS projectLogo, '2025-01-01' AS completionDate, "
            f"'published' AS projectPublishStatus FROM region")
LABELS = (f"SELECT 'S' || CAST(n_nationkey AS VARCHAR) AS _id, {org('n_nationkey')} AS orgId, 'lead_status' AS entityName, "
          f"CASE WHEN n_regionkey = 1 THEN 'Booked' ELSE n_name END AS labelName FROM nation")


def _funnel_sql(channel: str, as_stored: bool = False) -> str:
    """Reference-shaped funnel: left joins, per-event dedup, per-lead flags,
    COUNT(DISTINCT CASE ...)."""
    log_key = digits if as_stored else phone_key
    lead_key = phone_key("phone") if not as_stored else normalize_phone("phone") if channel == "sms" else "phone"
    if channel == "whatsapp":
        logs = f"""
SELECT json_extract_string(props, '$.k') AS campaignId, {org('user_id')} AS organisationId,
       {case_map(pick(T.WHATSAPP_STATUSES, 'event_id'), WHATSAPP_ENGAGEMENT, PASSTHROUGH)} AS canonical_event,
       {log_key("('+91 ' || " + base('user_id') + ")")} AS to_key, ts + {LOCAL} AS event_ts_local
FROM events"""
        camp_on = "g.campaignId = c._id AND g.organisationId = c.organisationId"
        lead_on = "g.to_key = l.pkey AND g.organisationId = l.orgId"
        keys = "campaignid, campaignname, campaignchannel, orgId"
        key_sel = "g.campaignId AS campaignid, c.name AS campaignname, c.channel AS campaignchannel, g.organisationId AS orgId"
        flag_defs = """max(CASE WHEN canonical_event = 'read' THEN 1 ELSE 0 END) AS r,
       max(CASE WHEN canonical_event = 'click' THEN 1 ELSE 0 END) AS k,
       max(CASE WHEN canonical_event = 'delivered' THEN 1 ELSE 0 END) AS d,"""
        counts = """count(DISTINCT CASE WHEN r = 1 THEN leadId END) AS whatsapp_read_unique,
       count(DISTINCT CASE WHEN k = 1 THEN leadId END) AS whatsapp_click_unique,
       count(DISTINCT CASE WHEN r = 1 AND k = 1 THEN leadId END) AS whatsapp_both_unique,
       count(DISTINCT CASE WHEN r = 1 AND k = 0 THEN leadId END) AS whatsapp_read_only_unique,
       count(DISTINCT CASE WHEN k = 1 AND r = 0 THEN leadId END) AS whatsapp_click_only_unique,
       count(DISTINCT CASE WHEN d = 1 THEN leadId END) AS whatsapp_delivered_unique,"""
        calls_row, calls_dedup = "", ""
    else:
        to = (f"CASE event_id % 3 WHEN 0 THEN {base('user_id')} WHEN 1 THEN '+91-' || {base('user_id')} "
              f"ELSE '91' || {base('user_id')} END")
        logs = f"""
SELECT json_extract_string(props, '$.k') AS campaignId, {SMS_ENGAGEMENT} AS canonical_event,
       {log_key(to)} AS to_key, ts + {LOCAL} AS event_ts_local
FROM events"""
        camp_on = "g.campaignId = c._id"
        lead_on = "g.to_key = l.pkey"
        keys = "campaignid, campaignname, campaignchannel"
        key_sel = "g.campaignId AS campaignid, c.name AS campaignname, c.channel AS campaignchannel"
        flag_defs = """max(CASE WHEN canonical_event = 'delivered' THEN 1 ELSE 0 END) AS d,
       max(calls_connected_flag) AS calls_connected_flag,"""
        counts = """count(DISTINCT CASE WHEN d = 1 THEN leadId END) AS sms_delivered_unique,
       count(DISTINCT CASE WHEN calls_connected_flag = 1 THEN leadId END) AS calls_connected_unique,"""
        calls_row = f", {connected('l.callDuration', 'l.callStatus')} AS calls_connected_flag"
        calls_dedup = ", max(calls_connected_flag) AS calls_connected_flag"
    return f"""
WITH logs AS ({logs}),
camp AS (SELECT CAST(p_partkey AS VARCHAR) AS _id, {org('p_partkey')} AS organisationId, p_name AS name, p_type AS channel FROM part),
dim AS (SELECT *, {lead_key} AS pkey FROM ({LEAD_DIM})),
raw AS (
  SELECT l.leadId, {key_sel}, g.canonical_event, g.event_ts_local,
         coalesce(l.site_visit_scheduled, FALSE) AS site_visit_scheduled, l.siteVisit_date,
         CASE WHEN {booked('l.bookingId', 'l.label')} THEN 1 ELSE 0 END AS booked_flag{calls_row}
  FROM logs g LEFT JOIN camp c ON {camp_on} LEFT JOIN dim l ON {lead_on}
  WHERE g.campaignId IS NOT NULL),
dedup AS (
  SELECT leadId, {keys}, canonical_event, min(event_ts_local) AS first_ts,
         max(site_visit_scheduled) AS site_visit_scheduled, max(siteVisit_date) AS siteVisit_date,
         max(booked_flag) AS booked_flag{calls_dedup}
  FROM raw WHERE leadId IS NOT NULL GROUP BY leadId, {keys}, canonical_event),
flags AS (
  SELECT {keys}, leadId, CAST(min(first_ts) AS DATE) AS event_date,
       {flag_defs}
       max(CASE WHEN site_visit_scheduled = TRUE THEN 1 ELSE 0 END) AS sv,
       max(CASE WHEN siteVisit_date IS NOT NULL THEN 1 ELSE 0 END) AS svd,
       max(booked_flag) AS b
  FROM dedup GROUP BY {keys}, leadId)
SELECT {keys}, event_date, count(DISTINCT leadId) AS total_unique_leads,
       {counts}
       count(DISTINCT CASE WHEN sv = 1 THEN leadId END) AS site_visit_scheduled_any_unique,
       count(DISTINCT CASE WHEN svd = 1 THEN leadId END) AS site_visit_delivered_any_unique,
       count(DISTINCT CASE WHEN b = 1 THEN leadId END) AS booked_any_unique
FROM flags GROUP BY {keys}, event_date"""


ORACLE: dict[str, str] = {
    "json_struct_flatten": """
SELECT event_id, props, json_extract_string(props, '$.k') AS props_k, CAST(NULL AS VARCHAR) AS props_missing
FROM events""",
    "json_path_extract": """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
    "missing_column_guard": """
SELECT o_orderkey, o_orderstatus, CAST(o_custkey AS VARCHAR) AS o_custkey_str, CAST(NULL AS VARCHAR) AS o_remark,
       CAST(NULL AS INTEGER) AS o_rank, CAST(NULL AS VARCHAR) AS payload_status
FROM orders""",
    "complex_to_json": """
SELECT o_orderkey, CAST(to_json([o_orderkey, o_custkey]) AS VARCHAR) AS keys_json,
       '{"' || o_orderstatus || '":' || CAST(o_custkey AS VARCHAR) || '}' AS map_json,
       CAST(to_json({'o_orderpriority': o_orderpriority, 'o_custkey': o_custkey}) AS VARCHAR) AS order_json
FROM orders""",
    "struct_input_flatten": """
SELECT event_id, event_type AS status, CAST(user_id AS VARCHAR) AS to_number, CAST(NULL AS VARCHAR) AS absent,
       upper(event_type) AS in_place_status
FROM events""",
    "variant_flatten": """
SELECT event_id, event_type AS status, CAST(user_id AS VARCHAR) AS to_number, event_type AS second_tag,
       CAST(NULL AS VARCHAR) AS absent, CAST(NULL AS VARCHAR) AS missing
FROM events""",
    "bronze_drift": """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS o_orderpriority, CAST(NULL AS VARCHAR) AS o_remark
FROM orders""",
    "left_join_hot_keys": """
SELECT c_custkey, c_name, event_id
FROM customer
LEFT JOIN (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS u
           FROM events) ON c_custkey = u""",
    "bucketed_join": """
SELECT c_custkey, c_name, o_orderkey, o_orderstatus FROM customer LEFT JOIN orders ON c_custkey = o_custkey""",
    "role_lookups_one_shuffle": f"""
WITH lab AS (SELECT 'S' || CAST(n_nationkey AS VARCHAR) AS id, {org('n_nationkey')} AS org, 'lead_status' AS entity,
                    CASE WHEN n_regionkey = 1 THEN 'Booked' ELSE n_name END AS label FROM nation),
     o AS (SELECT o_orderkey, {org('o_custkey')} AS org, 'S' || CAST(o_orderkey % 25 AS VARCHAR) AS status,
                  CASE WHEN o_orderkey % 3 = 0 THEN 'S' || CAST(o_orderkey % 40 AS VARCHAR) END AS source,
                  'S' || CAST(o_custkey % 25 AS VARCHAR) AS previous FROM orders)
SELECT o_orderkey, a.label AS status_label, a.entity AS entity, b.label AS source_label, c.label AS previous_label
FROM o
LEFT JOIN lab a ON o.status = a.id AND o.org = a.org
LEFT JOIN lab b ON o.source = b.id AND o.org = b.org
LEFT JOIN lab c ON o.previous = c.id AND o.org = c.org""",
    "table_replace_failed_write": """
SELECT o_orderkey, o_orderstatus FROM orders""",
    "epoch_ms_decimal_day": f"""
SELECT event_id, date_trunc('millisecond', ts) + {LOCAL} AS from_text,
       CAST(ts + {LOCAL} AS DATE) AS from_double, CAST(ts + {LOCAL} AS DATE) AS from_decimal
FROM events""",
    "date_text_day": f"""
SELECT event_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) + {LOCAL} AS from_day,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 1215 MINUTE + INTERVAL 420 MINUTE + {LOCAL} AS from_offset,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 1215 MINUTE + {LOCAL} AS from_plain
FROM events""",
    "left_join_composite": """
SELECT u.conv_id, u.turn, a.turn AS reply_turn, CAST(length(a.text) AS INTEGER) AS reply_chars
FROM conversations u
LEFT JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
WHERE u.role = 'user'""",
    "lookup_single_composite": """
SELECT c.c_custkey, n.n_name AS nation_name, s.s_name AS supplier_name
FROM customer c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN supplier s ON c.c_custkey = s.s_suppkey AND c.c_nationkey = s.s_nationkey""",
    "role_playing_lookup": """
SELECT l.l_orderkey, l.l_linenumber, cn.n_name AS cust_nation, sn.n_name AS supp_nation
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey
LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey""",
    "lookup_from_optional_side": """
SELECT c.c_custkey, s.s_suppkey, n.n_name AS supplier_nation
FROM customer c
LEFT JOIN supplier s ON c.c_custkey = s.s_suppkey
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "computed_key_join": f"""
SELECT e.event_id, p.p_name
FROM events e LEFT JOIN part p ON TRY_CAST({digits('e.props')} AS BIGINT) = p.p_partkey""",
    "json_key_join": f"""
SELECT e.event_id, p.p_name AS campaign_name
FROM events e LEFT JOIN part p
  ON json_extract_string(e.props, '$.k') = CAST(p.p_partkey AS VARCHAR) AND {org('e.user_id')} = {org('p.p_partkey')}""",
    "left_then_not_null": f"""
SELECT e.event_id, p.p_partkey, p.p_name
FROM events e JOIN part p ON TRY_CAST({digits('e.props')} AS BIGINT) = p.p_partkey""",
    "phone_normalise": f"""
SELECT c_custkey, phone, {normalize_phone('phone')} AS normalized_whatsapp_number, {phone_key('phone')} AS phone_key
FROM (SELECT c_custkey, {phone_text('c_custkey')} AS phone FROM customer)""",
    "presence_flag": f"""
WITH x AS (
  SELECT o_orderkey,
         CASE o_custkey % 5 WHEN 1 THEN '  ' WHEN 2 THEN 'None' WHEN 3 THEN '{{}}' WHEN 4 THEN 'null' END AS lead_json,
         CASE o_orderkey % 4 WHEN 1 THEN ' ' || chr(9) || ' ' WHEN 2 THEN 'None' WHEN 3 THEN o_orderpriority END AS log_next,
         CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS log_field,
         CASE WHEN o_orderstatus = 'F' THEN TRUE WHEN o_orderstatus = 'O' THEN FALSE END AS maybe_flag
  FROM orders)
SELECT o_orderkey, {present('lead_json')} AS lead_json_present,
       ({present('lead_json')} OR {present('log_next')} OR log_field IS NOT NULL) AS site_visit_scheduled,
       coalesce(maybe_flag, FALSE) AS flag_or_false
FROM x""",
    "booking_flags": f"""
WITH x AS (
  SELECT o_orderkey,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN CAST(o_orderkey AS VARCHAR) END AS booking_id,
         CASE o_orderstatus WHEN 'F' THEN 'Booked' WHEN 'O' THEN 'open' ELSE 'BOOKED' END AS label,
         CASE o_orderstatus WHEN 'F' THEN 'SV_DONE' WHEN 'O' THEN 'sv_done' END AS sub_status,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS created_at
  FROM orders)
SELECT o_orderkey, CASE WHEN {booked('booking_id', 'label')} THEN 1 ELSE 0 END AS booked_flag,
       CASE WHEN {booked('booking_id', 'label')} THEN created_at END AS booked_date,
       coalesce(sub_status IN ('SV_DONE'), FALSE) AS site_visit_completed
FROM x""",
    "json_temperature": "SELECT event_id, event_type AS lead_temperature FROM events",
    "canonical_event_sms": f"""
SELECT event_id, status, {case_map('status', SMS_RESPONSE)} AS response_event,
       {case_map('status', SMS_RESPONSE_CORRECTED)} AS response_event_corrected,
       engagement_event
FROM (SELECT event_id, {pick(T.SMS_STATUSES, 'event_id')} AS status, {SMS_ENGAGEMENT} AS engagement_event FROM events)""",
    "canonical_event_whatsapp": f"""
SELECT event_id, status, {case_map('status', WHATSAPP_ENGAGEMENT, PASSTHROUGH)} AS engagement_event,
       {case_map('status', WHATSAPP_RESPONSE)} AS response_event
FROM (SELECT event_id, {pick(T.WHATSAPP_STATUSES, 'event_id')} AS status FROM events)""",
    "canonical_event_email": f"""
SELECT event_id, status, {case_map('status', EMAIL_RESPONSE)} AS response_event
FROM (SELECT event_id, {pick(T.EMAIL_STATUSES, 'event_id')} AS status FROM events)""",
    "raw_status_fallback": f"""
SELECT 'sms' || CAST(event_id AS VARCHAR) AS _id,
       lower(coalesce({SMS_CODE}, {SMS_TYPE}, upper(event_type), 'sms' || CAST(event_id AS VARCHAR))) AS raw_status
FROM events""",
    "call_connected": f"""
SELECT event_id, {connected(
        "CASE event_id % 5 WHEN 0 THEN CAST(event_id % 3 AS VARCHAR) WHEN 1 THEN '1m 20s' WHEN 2 THEN '' WHEN 3 THEN '1.2.3' END",
        "CASE event_type WHEN 'click' THEN 'Answered' WHEN 'view' THEN 'in-progress' WHEN 'error' THEN 'busy' END")} AS calls_connected_flag
FROM events""",
    "local_event_day": f"""
SELECT event_id, ts + {LOCAL} AS event_ts_local, CAST(ts + {LOCAL} AS DATE) AS event_date FROM events""",
    "epoch_ms_day": f"""
SELECT event_id, epoch_us(ts) // 1000 AS epoch_ms, CAST(ts + {LOCAL} AS DATE) AS event_date FROM events""",
    "first_event_dedup": f"""
SELECT user_id, campaignid, canonical_event, min(event_ts_local) AS first_event_ts,
       max(high_value) AS high_value, max(event_type) AS event_type
FROM ({WA_ROWS}) GROUP BY user_id, campaignid, canonical_event""",
    "lead_flags": f"""
SELECT campaignid, user_id, min(event_ts_local) AS first_event_ts, CAST(min(event_ts_local) AS DATE) AS event_date,
       max(CASE WHEN canonical_event = 'read' THEN 1 ELSE 0 END) AS has_read,
       max(CASE WHEN canonical_event = 'click' THEN 1 ELSE 0 END) AS has_click
FROM ({WA_ROWS}) GROUP BY campaignid, user_id""",
    "whatsapp_funnel": _funnel_sql("whatsapp"),
    "sms_funnel": _funnel_sql("sms"),
    "funnels_as_stored": " UNION ALL ".join(
        f"SELECT '{c}' AS channel, campaignid, event_date, total_unique_leads, site_visit_scheduled_any_unique, "
        f"booked_any_unique FROM ({_funnel_sql(c, True)})" for c in ("sms", "whatsapp")),
    "union_channels": f"""
SELECT event_id, channel,
       CASE channel WHEN 'sms' THEN {pick(T.SMS_STATUSES, 'event_id')}
                    WHEN 'whatsapp' THEN {pick(T.WHATSAPP_STATUSES, 'event_id')}
                    ELSE {pick(T.EMAIL_STATUSES, 'event_id')} END AS status,
       orgId
FROM (SELECT event_id, {org('user_id')} AS orgId,
             CASE WHEN event_type IN ({_in(T.SMS_EVENT_TYPES)}) THEN 'sms'
                  WHEN event_type IN ({_in(T.WHATSAPP_EVENT_TYPES)}) THEN 'whatsapp'
                  WHEN event_type IN ({_in(T.EMAIL_EVENT_TYPES)}) THEN 'email' END AS channel
      FROM events)
WHERE channel IS NOT NULL""",
    "channel_pivot": PIVOT,
    "campaign_response": f"""
SELECT d.leadId, d.lead_flat_id, a.event_date, a.orgId, a.projectId,
       {", ".join("a." + o for o, _, _ in PIVOT_COLUMNS)}
FROM ({PIVOT}) a JOIN (SELECT DISTINCT lead_flat_id, leadId FROM ({LEAD_DIM})) d ON a.profileId = d.lead_flat_id""",

    "table_replace_roundtrip": f"""
SELECT CAST(p_partkey AS VARCHAR) AS _id, {org('p_partkey')} AS organisationId, p_name AS name, p_type AS channel
FROM part""",
}
# ---- M1 - M3: every column ----------------------------------------------------------
ORACLE["lead_flat"] = LEADS_FLAT
ORACLE["comm_logs_flat"] = LOGS_FLAT
_DERIVED = {
    "pms_LeadId": "CAST(NULL AS VARCHAR)",
    "normalized_whatsapp_number": normalize_phone("lf.profile_whatsAppNumber"),
    "site_visit_scheduled": f"({present('lf.original_siteVisit_json')} OR {present('lg.nextSiteVisit')} "
                            "OR lg.siteVisit_date IS NOT NULL OR lg.siteVisit_schedule IS NOT NULL "
                            "OR lg.siteVisit_time IS NOT NULL OR lg.siteVisitDate IS NOT NULL "
                            "OR lg.siteVisitTime IS NOT NULL)",
    "sirrus_lead_entity_name": "e.entityName", "sirrus_lead_status": "e.labelName",
    "previous_lead_status": "pl.labelName", "sirrus_sub_source_of_lead": "e2.labelName",
    "sirrus_source_of_lead": "e3.labelName",
    "booked_flag": f"CASE WHEN {booked('lg.bookingId', 'e.labelName')} THEN 1 ELSE 0 END",
    "Site_Visit_Completed": "coalesce(lg.payload_subStatus IN ('SV_DONE'), FALSE)",
    "booked_date": f"CASE WHEN {booked('lg.bookingId', 'e.labelName')} THEN lg.createdAt END",
    "lead_temperature": "lf.conversionPropensity_leadIntent",
}
_L360_SELECT = ",\n       ".join(
    f"{_DERIVED.get(name, source)} AS {name}" for name, source in map(_pair, LEAD_360))
ORACLE["lead_360"] = f"""
WITH lf AS ({LEADS_FLAT}), lg AS ({LOGS_FLAT}), p AS ({PROJECTS}), lab AS ({LABELS})
SELECT {_L360_SELECT}
FROM lf
LEFT JOIN lg ON lf._id = lg.leadId AND lf.orgId = lg.orgId AND lf.projectId = lg.projectId
LEFT JOIN p ON lf.projectId = p._id AND lf.orgId = p.orgId
LEFT JOIN lab e ON lf.leadStatus = e._id AND lf.orgId = e.orgId
LEFT JOIN lab e2 ON lf.profile_subSourceOfLead = e2._id AND lf.orgId = e2.orgId
LEFT JOIN lab e3 ON lf.profile_sourceOfLead = e3._id AND lf.orgId = e3.orgId
LEFT JOIN lab pl ON lg.prevStatus = pl._id AND lg.orgId = pl.orgId"""
ORACLE["job_row_counts"] = f"""
SELECT 'lead_flat' AS table_name, count(*) AS row_count FROM customer
UNION ALL SELECT 'comm_logs', count(*) FROM orders
UNION ALL SELECT 'lead_360', count(*) FROM ({ORACLE['lead_360']})"""
