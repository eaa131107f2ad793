"""CRM-shaped inputs derived from the driver's TPC-H-style test tables.

The test tables carry no CRM data, so each role is played by a table and every
CRM column is a deterministic function of that table's columns:

  customer -> leads (bronze, JSON text columns) and a lead dimension
  orders   -> communication logs (bronze, ``payload`` JSON)
  region   -> projects          nation -> entity labels
  part     -> campaigns         events -> SMS / WhatsApp / email webhook logs

Everything is lazy DataFrame code, so the derived inputs are as large as the
tables they come from.  ``plans.oracle`` restates the same rules in SQL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import schemas as S
from .lead_360 import LABEL_STATUS
from .lead_flat import ROOT_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---- fixed values: test vocabularies (raw statuses as providers send them) ----
WHATSAPP_STATUSES = (
    "read", "Seen", "MESSAGE_READ", "click", "URL_CLICK", "delivered", "Deliv",
    "queued", "SENT", "failed", "Replied", "reply", "unknown_status",
)
SMS_STATUSES = (
    "SENT", "submitd", "DELIVRD", "DLT HEADER FILTER", "Dlt Template Filter", "DLT VL FAILURE",
    "exp-abs-sub", "EXP-NW-FAIL", "Expired", "FAILED", "Invalid Request", "UNDELIV", "Click", "xyz",
)
EMAIL_STATUSES = (
    "processed", "Dropped", "Bounced", "REJECTED", "sent", "delivered", "open", "OPENED", "click",
    "Clicked", "spam", "unsubscribe", "Unsubscribed", "deferred",
)
# event_type -> channel, for the three-channel response feed
SMS_EVENT_TYPES = ("click", "error")
WHATSAPP_EVENT_TYPES = ("view", "signup")
EMAIL_EVENT_TYPES = ("purchase",)


def pick(vocab: Sequence[str], k: Column) -> Column:
    """``vocab[k mod len]`` - a status chosen by a row's own id."""
    return F.element_at(F.array(*[F.lit(v) for v in vocab]), (F.pmod(k, F.lit(len(vocab))) + 1).cast("int"))


def org_of(k: Column) -> Column:
    return F.concat(F.lit("org"), F.pmod(k, F.lit(3)).cast("string"))


def project_of(k: Column) -> Column:
    return F.concat(F.lit("P"), F.pmod(k, F.lit(7)).cast("string"))


def base_number(k: Column) -> Column:
    """A 10-digit national number per key."""
    return (F.lit(9000000000) + k).cast("string")


def phone_text(k: Column) -> Column:
    """The same number written eight ways (all phone-rule branches, empty, NULL)."""
    b = base_number(k)
    form = F.pmod(k, F.lit(8))
    return (
        F.when(form == 0, F.concat(F.lit("+91 "), b))
        .when(form == 1, F.concat(F.lit("91"), b))
        .when(form == 2, F.concat(F.lit("+91"), F.substring(b, 1, 4)))
        .when(form == 3, F.concat(F.lit("91"), F.substring(b, 3, 3), F.lit("-"), F.substring(b, 6, 5)))
        .when(form == 4, F.concat(F.lit("+1 "), F.substring(b, 1, 3), F.lit(" "),
                                   F.substring(b, 4, 3), F.lit(" "), F.substring(b, 7, 4)))
        .when(form == 5, F.concat(F.substring(b, 1, 5), F.lit(" "), F.substring(b, 6, 5)))
        .when(form == 6, F.lit(""))
        .otherwise(F.lit(None).cast("string"))
    )


def epoch_ms(ts_ntz: Column) -> Column:
    """Milliseconds since 1970-01-01 of a wall-clock UTC timestamp.  The instant is
    built with an explicit UTC zone, so the session zone plays no part."""
    instant = F.make_timestamp(
        F.year(ts_ntz), F.month(ts_ntz), F.dayofmonth(ts_ntz), F.hour(ts_ntz), F.minute(ts_ntz),
        F.date_part(F.lit("SECOND"), ts_ntz), F.lit("UTC"),
    )
    return F.unix_millis(instant)


def filler(name: str, k: Column) -> Column:
    """A value that tells which field and which row it belongs to: ``name:<k mod 11>``."""
    return F.concat(F.lit(f"{name}:"), F.pmod(k, F.lit(11)).cast("string"))


def document(schema: StructType, k: Column, values: Mapping[str, Column], path: str = "") -> Column:
    """A struct of ``schema``'s fields: ``values`` by dotted path, fillers elsewhere."""
    fields = []
    for f in schema.fields:
        at = f"{path}{f.name}"
        if at in values:
            value = values[at]
        elif isinstance(f.dataType, StructType):
            value = document(f.dataType, k, values, f"{at}.")
        else:
            value = filler(at, k)
        fields.append(value.alias(f.name))
    return F.struct(*fields)


# ---- leads / logs / lookups ---------------------------------------------------
def leads_bronze(customer: DataFrame) -> DataFrame:
    """Every root column and every field of the JSON documents has values."""
    k = F.col("c_custkey")
    visit = document(S.site_visit_schema(), k, {
        "date": F.concat(F.lit("2024-02-"), F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0")),
        "modeOfVisit": F.col("c_mktsegment"),
    })
    form = F.pmod(k, F.lit(4))
    profile = document(S.profile_schema(), k, {
        "fullName": F.col("c_name"),
        "age": F.pmod(k, F.lit(60)) + 20,
        "whatsAppNumber": phone_text(k),
        "sourceOfLead": F.concat(F.lit("S"), F.pmod(F.col("c_nationkey") + 1, F.lit(25)).cast("string")),
        "subSourceOfLead": F.concat(F.lit("S"), F.pmod(F.col("c_nationkey") + 3, F.lit(25)).cast("string")),
    })
    known = {
        "_id": k.cast("string"),
        "orgId": org_of(k),
        "leadId": F.concat(F.lit("L"), k.cast("string")),
        "projectId": project_of(k),
        "leadStatus": F.concat(F.lit("S"), F.col("c_nationkey").cast("string")),
        "isActive": F.col("c_acctbal") > 0,
    }
    return customer.select(
        *[known.get(c, filler(c, k)).alias(c) for c in ROOT_COLUMNS],
        F.to_json(profile).alias("profile"),
        F.when(form == 1, F.lit("  ")).when(form == 2, F.to_json(visit)).when(form == 3, F.lit("None")).alias("siteVisit"),
        F.to_json(document(S.property_interest_schema(), k, {})).alias("propertyInterest"),
        F.to_json(document(S.conversion_propensity_schema(), k, {"leadIntent": F.col("c_mktsegment")}))
        .alias("conversionPropensity"),
    )


def comm_logs_bronze(orders: DataFrame) -> DataFrame:
    """Every field of the payload has values; the site-visit fields only in some rows."""
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    status, prio = F.col("o_orderstatus"), F.col("o_orderpriority")
    third, fourth = F.pmod(ok, F.lit(3)), F.pmod(ok, F.lit(4))
    payload = document(S.payload_schema(), ok, {
        "projectId": F.when(prio != "5-LOW", project_of(ck)),
        "prevStatus": F.concat(F.lit("S"), F.pmod(ok, F.lit(25)).cast("string")),
        "bookingId": F.when(status == "F", F.concat(F.lit("B"), ok.cast("string"))),
        "subStatus": F.when(prio == "1-URGENT", F.lit("SV_DONE")),
        "createdAt": F.to_date(F.col("o_orderdate")).cast("string"),
        "nextSiteVisit": F.when(third == 0, F.lit("None")).when(third == 1, F.lit("2024-03-01")),
        "siteVisit.date": F.when(status == "O", F.lit("2024-04-01")),
        **{f: F.when(fourth == 3, filler(f, ok))
           for f in ("siteVisit.time", "siteVisit.schedule", "siteVisitDate", "siteVisitTime")},
        "callDuration": F.when(third == 0, F.lit("1m 20s")).when(third == 1, F.lit("0")),
        "callStatus": F.when(prio == "2-HIGH", F.lit("answered")),
        "viewed": status == "P",
        "callEnded": F.pmod(ok, F.lit(2)) == 0,
        "assignmentHistory": F.array(filler("first", ok), filler("then", ck)),
        "Legs": F.array(F.struct(filler("duration", ok).alias("onCallDuration"), filler("leg", ok).alias("status"))),
    })
    return orders.select(
        ok.cast("string").alias("_id"),
        org_of(ck).alias("orgId"),
        ck.cast("string").alias("leadId"),
        F.to_json(payload).alias("payload"),
    )


def projects(region: DataFrame) -> DataFrame:
    r = F.col("r_regionkey")
    return region.select(
        F.concat(F.lit("P"), r.cast("string")).alias("_id"),
        org_of(r).alias("orgId"),
        F.col("r_name").alias("projectName"),
        F.lit("active").alias("projectStatus"),
        F.concat(F.lit("logo"), r.cast("string")).alias("projectLogo"),
        F.lit("2025-01-01").alias("completionDate"),
        F.lit("published").alias("projectPublishStatus"),
    )


def entity_labels(nation: DataFrame) -> DataFrame:
    n = F.col("n_nationkey")
    return nation.select(
        F.concat(F.lit("S"), n.cast("string")).alias("_id"),
        org_of(n).alias("orgId"),
        F.lit("lead_status").alias("entityName"),
        F.when(F.col("n_regionkey") == 1, F.lit("Booked")).otherwise(F.col("n_name")).alias("labelName"),
    )


def campaigns(part: DataFrame) -> DataFrame:
    p = F.col("p_partkey")
    return part.select(
        p.cast("string").alias("_id"),
        org_of(p).alias("organisationId"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("channel"),
    )


def lead_dim(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """A lead-360-shaped dimension (the columns the funnels and responses read): a row
    per lead x log with flags that differ between the rows of a lead; leads without a
    log keep one row."""
    k, o, bal, seg = F.col("c_custkey"), F.col("o_orderkey"), F.col("c_acctbal"), F.col("c_mktsegment")
    rows = customer.join(
        orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"),
        k == F.col("o_custkey"), "left")
    return rows.select(
        k.cast("string").alias("lead_flat_id"),
        F.concat(F.lit("L"), k.cast("string")).alias("leadId"),
        org_of(k).alias("orgId"),
        phone_text(k).alias("profile_whatsAppNumber"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(True))
        .when(seg == "HOUSEHOLD", F.lit(None).cast("boolean")).otherwise(bal > 8000).alias("site_visit_scheduled"),
        F.when((F.col("o_orderstatus") == "F") & (bal > 5000),
               F.concat(F.lit("2024-02-"), F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0"))).alias("siteVisit_date"),
        F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("B"), o.cast("string"))).alias("bookingId"),
        F.when(seg == "AUTOMOBILE", F.lit("Booked")).when(seg == "MACHINERY", F.lit("BOOKED")).otherwise(seg).alias(LABEL_STATUS),
        F.when(F.pmod(o, F.lit(9)) == 0, F.lit("1m 20s")).when(F.pmod(o, F.lit(3)) == 1, F.lit("0")).alias("callDuration"),
        F.when(F.pmod(o, F.lit(32)) == 0, F.lit("Answered")).when(F.pmod(o, F.lit(4)) == 1, F.lit("no-answer")).alias("callStatus"),
    )


# ---- webhook logs -------------------------------------------------------------
def _campaign_id() -> Column:
    return F.get_json_object(F.col("props"), "$.k")


def sms_provider_response(e: Column) -> Column:
    pr = F.pmod(e, F.lit(4))
    return (
        F.when(pr == 0, F.lit('{"status":{"code":200,"desc":"OK"}}'))
        .when(pr == 1, F.lit('{"status":{"code":"500","desc":"Message Accepted"}}'))
        .when(pr == 2, F.lit('{"status":{"code":"404","desc":"failed"}}'))
    )


def sms_type(e: Column) -> Column:
    ty = F.pmod(e, F.lit(5))
    return (F.when(ty == 0, F.lit("DELIVERY")).when(ty == 1, F.lit("Delivered"))
            .when(ty == 2, F.lit("submit")))


def sms_logs(events: DataFrame) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    form = F.pmod(e, F.lit(3))
    to = (F.when(form == 0, base_number(u))
          .when(form == 1, F.concat(F.lit("+91-"), base_number(u)))
          .otherwise(F.concat(F.lit("91"), base_number(u))))
    return events.select(
        F.concat(F.lit("sms"), e.cast("string")).alias("_id"),
        _campaign_id().alias("campaignId"),
        to.alias("to"),
        sms_provider_response(e).alias("providerResponse"),
        sms_type(e).alias("type"),
        F.to_json(F.struct(F.upper(F.col("event_type")).alias("status"))).alias("payload"),
        F.col("ts").alias("createdAt"),
        org_of(u).alias("organisationId"),
    )


def whatsapp_logs(events: DataFrame) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    payload = F.to_json(F.struct(
        F.struct(F.concat(F.lit("+91 "), base_number(u)).alias("to")).alias("recipient"),
        F.struct(epoch_ms(F.col("ts")).alias("timestamp")).alias("events"),
        project_of(u).alias("projectId"),
    ))
    return events.select(
        _campaign_id().alias("campaignId"),
        org_of(u).alias("organisationId"),
        pick(WHATSAPP_STATUSES, e).alias("status"),
        payload.alias("payload"),
        F.col("ts").alias("updatedAt"),
        u.cast("string").alias("profileId"),
    )


def sms_webhooks(events: DataFrame) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    return events.where(F.col("event_type").isin(*SMS_EVENT_TYPES)).select(
        pick(SMS_STATUSES, e).alias("status"),
        F.col("ts").alias("updatedAt"),
        org_of(u).alias("organisationId"),
        project_of(u).alias("projectId"),
        u.cast("string").alias("profileId"),
    )


def whatsapp_webhooks(events: DataFrame) -> DataFrame:
    return whatsapp_logs(events.where(F.col("event_type").isin(*WHATSAPP_EVENT_TYPES)))


def email_webhooks(events: DataFrame) -> DataFrame:
    """No ``projectId`` column: the response job must add it as NULL."""
    e, u = F.col("event_id"), F.col("user_id")
    return events.where(F.col("event_type").isin(*EMAIL_EVENT_TYPES)).select(
        org_of(u).alias("organisationId"),
        pick(EMAIL_STATUSES, e).alias("status"),
        u.cast("string").alias("profileId"),
        F.col("ts").alias("createdAt"),
    )
