"""Named queries over the driver's test tables, one per operator group of the
inventory (IDs in brackets).  Each takes (spark, sf_dir) and returns a DataFrame
over the *whole* input tables; ``plans.oracle`` has the matching SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ..functions import events as EV
from ..functions.flags import (
    booked_date,
    booked_flag,
    call_connected,
    flag_if,
    lead_temperature,
    null_to_false,
    site_visit_completed,
    site_visit_scheduled,
    sms_raw_status,
)
from ..functions.text import digits, is_present, normalize_phone, phone_key
from ..functions.time import local_event_time, local_event_time_from_epoch_ms
from ..operators.flatten import flatten
from ..operators.funnel import first_event_dedup, lead_flags as lead_flags_op
from ..operators.guards import complex_to_json, ensure_column, parse_or_null, safe_scalar, safe_struct
from ..operators.joins import left_join_one_to_many, left_join_salted, lookup, role_lookups, role_lookups_once
from ..operators.pivot import channel_pivot, union_channels
from ..session import scratch_dir
from ..sources.catalog import count_hot_keys, ensure_namespace, read_table, replace_table
from ..sources.files import read_bronze
from . import jobs
from . import testbed as T
from .comm_logs import communication_logs_flat
from .engagement import sms_engagement, whatsapp_engagement
from .lead_flat import lead_flat as lead_flat_plan
from .response import RESPONSE_COLUMNS, campaign_response as campaign_response_plan, channel_events

Query = Callable[[SparkSession, str], DataFrame]


def _events(spark: SparkSession, d: str) -> DataFrame:
    return T.table(spark, d, "events")


# ---- C / P / X: JSON, guards, projections -------------------------------------
def json_struct_flatten(spark, d):
    """[C1 C2 P1 P3 X10] props -> declared struct -> prefixed columns, raw text kept."""
    ev = _events(spark, d)
    schema = StructType([StructField("k", StringType()), StructField("missing", StringType())])
    parsed = ev.select("event_id", "props", safe_struct(ev, "props", schema).alias("__p"))
    return parsed.select("event_id", "props", *flatten("__p", "props", ["k", "missing"]))


def json_path_extract(spark, d):
    """[X9 X12] ``$.k`` -> bigint; text that is not a number gives NULL."""
    return _events(spark, d).select(
        "event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k")
    )


def missing_column_guard(spark, d):
    """[C3 C4 C5] absent columns become typed NULLs; present ones are cast."""
    o = T.table(spark, d, "orders")
    payload = StructType([StructField("status", StringType())])
    df = ensure_column(o, "o_rank", IntegerType())
    df = ensure_column(df, "o_orderstatus", IntegerType())  # present: left untouched
    df = parse_or_null(df, "payload", payload)
    return df.select(
        "o_orderkey",
        "o_orderstatus",
        safe_scalar(o, "o_custkey").alias("o_custkey_str"),
        safe_scalar(o, "o_remark").alias("o_remark"),
        F.col("o_rank"),
        F.col("payload.status").alias("payload_status"),
    )


def complex_to_json_query(spark, d):
    """[C6 X11] array, map and struct columns -> JSON text, scalars untouched."""
    o = T.table(spark, d, "orders")
    df = o.select(
        "o_orderkey",
        F.array("o_orderkey", "o_custkey").alias("keys_json"),
        F.create_map(F.col("o_orderstatus"), F.col("o_custkey")).alias("map_json"),
        F.struct("o_orderpriority", "o_custkey").alias("order_json"),
    )
    return complex_to_json(df)


def struct_input_flatten(spark, d):
    """[C2 C5 P1] native struct columns where JSON text is usual: same result."""
    ev = _events(spark, d).select("event_id", F.struct(
        F.col("event_type").alias("status"),
        F.struct(F.col("user_id").alias("to")).alias("recipient"),
        F.array("event_type").alias("tags"),
    ).alias("payload"))
    schema = StructType([
        StructField("status", StringType()),
        StructField("recipient", StructType([StructField("to", StringType())])),
        StructField("absent", StringType()),
    ])
    by_select = ev.select("event_id", safe_struct(ev, "payload", schema).alias("__p")).select(
        "event_id", F.col("__p.status").alias("status"), F.col("__p.recipient.to").alias("to_number"),
        F.col("__p.absent").alias("absent"))
    in_place = parse_or_null(ev, "payload", schema).select(
        F.col("event_id").alias("__id"), F.upper("payload.status").alias("in_place_status"))
    return by_select.join(in_place, F.col("event_id") == F.col("__id")).drop("__id")


def variant_flatten(spark, d):
    """[C2 P1] a VARIANT column where JSON text is usual: nested fields by path, absent ones
    NULL."""
    ev = _events(spark, d)
    doc = F.to_json(F.struct(
        F.col("event_type").alias("status"),
        F.struct(F.col("user_id").alias("to"), F.array("event_type", "event_type").alias("tags")).alias("recipient"),
        F.col("props").alias("props")))
    ev = ev.select("event_id", F.parse_json(doc).alias("payload"))
    schema = StructType([
        StructField("status", StringType()),
        StructField("recipient", StructType([
            StructField("to", StringType()), StructField("tags", ArrayType(StringType())), StructField("absent", StringType())])),
        StructField("missing", StringType()),
    ])
    return ev.select("event_id", safe_struct(ev, "payload", schema).alias("__p")).select(
        "event_id", F.col("__p.status").alias("status"), F.col("__p.recipient.to").alias("to_number"),
        F.col("__p.recipient.tags")[1].alias("second_tag"), F.col("__p.recipient.absent").alias("absent"),
        F.col("__p.missing").alias("missing"))


def bronze_drift(spark, d):
    """[S1 C4] a folder whose older files lack a column and whose newer ones lack another:
    both are read where they are, and are NULL elsewhere."""
    path = f"{scratch_dir(spark)}/bronze_drift_{uuid.uuid4().hex}"
    o = T.table(spark, d, "orders").withColumn("old", F.col("o_orderkey") % 2 == 0)
    o.where("old").select("o_orderkey", "o_orderstatus").write.parquet(path)
    o.where("not old").select("o_orderkey", "o_orderpriority").write.mode("append").parquet(path)
    return read_bronze(spark, path, ["o_orderstatus", "o_orderpriority", "o_remark"]).select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "o_remark")


# ---- J: joins -----------------------------------------------------------------
def left_join_composite(spark, d):
    """[J1] user turn x the assistant turn that follows it (conv id, turn + 1);
    user turns without a reply kept once."""
    c = T.table(spark, d, "conversations")
    users = c.where(F.col("role") == "user").select("conv_id", "turn", (F.col("turn") + 1).alias("next_turn"))
    replies = c.where(F.col("role") == "assistant").select(
        "conv_id", "turn", F.length("text").alias("reply_chars")
    )
    out = left_join_one_to_many(
        users, replies, on=[("conv_id", "conv_id"), ("next_turn", "turn")],
        right_columns={"turn": "reply_turn", "reply_chars": "reply_chars"},
    )
    return out.select("conv_id", "turn", "reply_turn", "reply_chars")


def left_join_hot_keys(spark, d):
    """[J1] customers x events where one customer has a third of the events and some events
    have no customer: one pass, the hot key found by a bounded summary."""
    e = F.col("event_id")
    events = _events(spark, d).select(
        "event_id", F.when(e % 11 == 0, None).when(e % 3 == 0, 7).otherwise(F.col("user_id")).alias("user_id"))
    hot = count_hot_keys(events, ["user_id"])
    customers = T.table(spark, d, "customer").select("c_custkey", "c_name")
    return left_join_salted(
        customers, events, [("c_custkey", "user_id")], {"event_id": "event_id"}, hot).select("c_custkey", "c_name", "event_id")


def bucketed_join(spark, d):
    """[J1 S3] customers x orders from tables in the same number of buckets: no exchange."""
    customers, orders = T.table(spark, d, "customer"), T.table(spark, d, "orders")
    ns = _namespace(spark)
    replace_table(customers.select("c_custkey", "c_nationkey", "c_name"), f"{ns}.customers", bucket_by=(8, ["c_custkey"]))
    replace_table(orders.select("o_orderkey", "o_custkey", "o_orderstatus"), f"{ns}.orders", bucket_by=(8, ["o_custkey"]))
    return left_join_one_to_many(
        read_table(spark, f"{ns}.customers"), read_table(spark, f"{ns}.orders"), [("c_custkey", "o_custkey")],
        {"o_orderkey": "o_orderkey", "o_orderstatus": "o_orderstatus"}, skew_safe=False,
    ).select("c_custkey", "c_name", "o_orderkey", "o_orderstatus")


def lookup_single_composite(spark, d):
    """[J2 J5 J6] single-key lookup (nation) and composite-key lookup (supplier by
    id and nation)."""
    cust = T.table(spark, d, "customer").select("c_custkey", "c_nationkey")
    df = lookup(cust, T.table(spark, d, "nation"), [("c_nationkey", "n_nationkey")],
                {"n_name": "nation_name"}, role="nation")
    df = lookup(df, T.table(spark, d, "supplier"),
                [("c_custkey", "s_suppkey"), ("c_nationkey", "s_nationkey")],
                {"s_name": "supplier_name"}, role="supplier")
    return df.select("c_custkey", "nation_name", "supplier_name")


def role_playing_lookup(spark, d):
    """[J3] one lookup table (nation) in two roles on the same row: the
    customer's nation and the supplier's nation of each line."""
    li = T.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    orders = T.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    df = li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    df = lookup(df, T.table(spark, d, "customer"), [("o_custkey", "c_custkey")],
                {"c_nationkey": "c_nationkey"}, role="customer")
    df = lookup(df, T.table(spark, d, "supplier"), [("l_suppkey", "s_suppkey")],
                {"s_nationkey": "s_nationkey"}, role="supplier")
    df = role_lookups(df, T.table(spark, d, "nation"), {
        "cust_nation": ([("c_nationkey", "n_nationkey")], {"n_name": "cust_nation"}),
        "supp_nation": ([("s_nationkey", "n_nationkey")], {"n_name": "supp_nation"}),
    })
    return df.select("l_orderkey", "l_linenumber", "cust_nation", "supp_nation")


def role_lookups_one_shuffle(spark, d):
    """[J3 J4] three roles of one lookup table by a single join of narrow rows; one role is
    often NULL, one often without a match."""
    o = T.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    k = F.col("o_orderkey")
    df = o.select(
        "o_orderkey", T.org_of(F.col("o_custkey")).alias("org"),
        F.concat(F.lit("S"), (k % 25).cast("string")).alias("status"),
        F.when(k % 3 == 0, F.concat(F.lit("S"), (k % 40).cast("string"))).alias("source"),
        F.concat(F.lit("S"), (F.col("o_custkey") % 25).cast("string")).alias("previous"))
    return role_lookups_once(df, T.entity_labels(T.table(spark, d, "nation")), {
        "status": ([("status", "_id"), ("org", "orgId")], {"labelName": "status_label", "entityName": "entity"}),
        "source": ([("source", "_id"), ("org", "orgId")], {"labelName": "source_label"}),
        "previous": ([("previous", "_id"), ("org", "orgId")], {"labelName": "previous_label"}),
    }).select("o_orderkey", "status_label", "entity", "source_label", "previous_label")


def lookup_from_optional_side(spark, d):
    """[J4] a lookup keyed by a column of the nullable side of an earlier left join."""
    cust = T.table(spark, d, "customer").select("c_custkey")
    df = lookup(cust, T.table(spark, d, "supplier"), [("c_custkey", "s_suppkey")],
                {"s_suppkey": "s_suppkey", "s_nationkey": "s_nationkey"}, role="supplier")
    df = lookup(df, T.table(spark, d, "nation"), [("s_nationkey", "n_nationkey")],
                {"n_name": "supplier_nation"}, role="nation")
    return df.select("c_custkey", "s_suppkey", "supplier_nation")


def computed_key_join(spark, d):
    """[J7 X2] key computed from text: the digits of ``props`` = part key."""
    ev = _events(spark, d).select("event_id", "props")
    df = lookup(ev, T.table(spark, d, "part"),
                [(digits(F.col("props")).try_cast("bigint"), "p_partkey")],
                {"p_name": "p_name"}, role="part")
    return df.select("event_id", "p_name")


def json_key_join(spark, d):
    """[J8 J6] key from a JSON path plus an org key: campaign by id and org."""
    ev = _events(spark, d).select("event_id", "props", T.org_of(F.col("user_id")).alias("organisationId"))
    df = lookup(ev, T.campaigns(T.table(spark, d, "part")),
                [(F.get_json_object("props", "$.k"), "_id"), ("organisationId", "organisationId")],
                {"name": "campaign_name"}, role="campaign")
    return df.select("event_id", "campaign_name")


def left_then_not_null(spark, d):
    """[J10 F1] left join then a NOT NULL filter on the lookup side: an inner join."""
    ev = _events(spark, d).select("event_id", "props")
    df = lookup(ev, T.table(spark, d, "part"),
                [(digits(F.col("props")).try_cast("bigint"), "p_partkey")],
                {"p_partkey": "p_partkey", "p_name": "p_name"}, role="part")
    return df.where(F.col("p_partkey").isNotNull()).select("event_id", "p_partkey", "p_name")


# ---- E: business expressions --------------------------------------------------
def phone_normalise(spark, d):
    """[E1 X3 X4 X5 F7] the stored form and the join key of eight phone spellings."""
    c = T.table(spark, d, "customer").select("c_custkey", T.phone_text(F.col("c_custkey")).alias("phone"))
    return c.select(
        "c_custkey", "phone",
        normalize_phone(F.col("phone")).alias("normalized_whatsapp_number"),
        phone_key(F.col("phone")).alias("phone_key"),
    )


def _presence_inputs(orders: DataFrame) -> DataFrame:
    ok, ck, st = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    m5, m4 = F.pmod(ck, F.lit(5)), F.pmod(ok, F.lit(4))
    return orders.select(
        "o_orderkey",
        F.when(m5 == 1, F.lit("  ")).when(m5 == 2, F.lit("None")).when(m5 == 3, F.lit("{}"))
        .when(m5 == 4, F.lit("null")).alias("lead_json"),
        F.when(m4 == 1, F.lit(" \t ")).when(m4 == 2, F.lit("None"))
        .when(m4 == 3, F.col("o_orderpriority")).alias("log_next"),
        F.when(st == "P", F.col("o_orderpriority")).alias("log_field"),
        F.when(st == "F", F.lit(True)).when(st == "O", F.lit(False)).alias("maybe_flag"),
    )


def presence_flag(spark, d):
    """[E2 F2 E16] present-text rule and the site-visit-scheduled chain."""
    df = _presence_inputs(T.table(spark, d, "orders"))
    return df.select(
        "o_orderkey",
        is_present(F.col("lead_json")).alias("lead_json_present"),
        site_visit_scheduled(F.col("lead_json"), F.col("log_next"), F.col("log_field")).alias("site_visit_scheduled"),
        null_to_false(F.col("maybe_flag")).alias("flag_or_false"),
    )


def booking_flags(spark, d):
    """[E3 E4 E5 F5] booking flag and date from booking id + label; visit done."""
    o = T.table(spark, d, "orders")
    st = F.col("o_orderstatus")
    df = o.select(
        "o_orderkey",
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("o_orderkey").cast("string")).alias("booking_id"),
        F.when(st == "F", F.lit("Booked")).when(st == "O", F.lit("open")).otherwise(F.lit("BOOKED")).alias("label"),
        F.when(st == "F", F.lit("SV_DONE")).when(st == "O", F.lit("sv_done")).alias("sub_status"),
        F.to_date("o_orderdate").cast("string").alias("created_at"),
    )
    b, lab = F.col("booking_id"), F.col("label")
    return df.select(
        "o_orderkey",
        booked_flag(b, lab).alias("booked_flag"),
        booked_date(b, lab, F.col("created_at")).alias("booked_date"),
        site_visit_completed(F.col("sub_status")).alias("site_visit_completed"),
    )


def json_temperature(spark, d):
    """[E6] ``$.leadIntent`` of a conversion-propensity document."""
    ev = _events(spark, d)
    doc = F.to_json(F.struct(F.col("event_type").alias("leadIntent"), F.col("value").alias("probability")))
    return ev.select("event_id", lead_temperature(doc).alias("lead_temperature"))


def canonical_event_whatsapp(spark, d):
    """[E9 E11 F3 F9] engagement (unmatched passes through) and response (unmatched NULL)."""
    ev = _events(spark, d).select("event_id", T.pick(T.WHATSAPP_STATUSES, F.col("event_id")).alias("status"))
    s = F.col("status")
    return ev.select(
        "event_id", "status",
        EV.canonical_event(s, EV.WHATSAPP_ENGAGEMENT, EV.PASSTHROUGH).alias("engagement_event"),
        EV.canonical_event(s, EV.WHATSAPP_RESPONSE).alias("response_event"),
    )


def canonical_event_sms(spark, d):
    """[E8 E10 F3 F4 F9] SMS response (as shipped and corrected) and engagement."""
    e = F.col("event_id")
    ev = _events(spark, d).select(
        "event_id",
        T.pick(T.SMS_STATUSES, e).alias("status"),
        T.sms_provider_response(e).alias("providerResponse"),
        T.sms_type(e).alias("type"),
    )
    s = F.col("status")
    pr = F.col("providerResponse")
    return ev.select(
        "event_id", "status",
        EV.canonical_event(s, EV.SMS_RESPONSE).alias("response_event"),
        EV.canonical_event(s, EV.SMS_RESPONSE_CORRECTED).alias("response_event_corrected"),
        EV.sms_engagement_event(
            F.get_json_object(pr, "$.status.code"), F.get_json_object(pr, "$.status.desc"), F.col("type")
        ).alias("engagement_event"),
    )


def canonical_event_email(spark, d):
    """[E12 F3 F9]"""
    ev = _events(spark, d).select("event_id", T.pick(T.EMAIL_STATUSES, F.col("event_id")).alias("status"))
    return ev.select("event_id", "status", EV.canonical_event(F.col("status"), EV.EMAIL_RESPONSE).alias("response_event"))


def raw_status_fallback(spark, d):
    """[E7 X7] first non-NULL of provider code, type, payload status, id; lower-cased."""
    logs = T.sms_logs(_events(spark, d))
    return logs.select(
        "_id",
        sms_raw_status(F.col("providerResponse"), F.col("type"), F.col("payload"), F.col("_id")).alias("raw_status"),
    )


def call_connected_query(spark, d):
    """[E13 F6 F8] connected by cleaned duration text or by status."""
    ev = _events(spark, d)
    e, et = F.col("event_id"), F.col("event_type")
    m = F.pmod(e, F.lit(5))
    duration = (F.when(m == 0, F.format_string("%d", F.pmod(e, F.lit(3))))
                .when(m == 1, F.lit("1m 20s")).when(m == 2, F.lit("")).when(m == 3, F.lit("1.2.3")))
    status = (F.when(et == "click", F.lit("Answered")).when(et == "view", F.lit("in-progress"))
              .when(et == "error", F.lit("busy")))
    return ev.select("event_id", call_connected(duration, status).alias("calls_connected_flag"))


def local_event_day(spark, d):
    """[E14 X14 X15] wall-clock UTC timestamp -> local time and day."""
    ev = _events(spark, d)
    local = local_event_time(F.col("ts"), ev.schema["ts"].dataType)
    return ev.select("event_id", local.alias("event_ts_local"), F.to_date(local).alias("event_date"))


def epoch_ms_day(spark, d):
    """[E15 X13 X16] epoch milliseconds (as JSON text) -> local day."""
    ev = _events(spark, d)
    payload = F.to_json(F.struct(F.struct(T.epoch_ms(F.col("ts")).alias("timestamp")).alias("events")))
    ms = F.get_json_object(payload, "$.events.timestamp")
    return ev.select(
        "event_id",
        ms.try_cast("bigint").alias("epoch_ms"),
        F.to_date(local_event_time_from_epoch_ms(ms)).alias("event_date"),
    )


def epoch_ms_decimal_day(spark, d):
    """[E15] epoch milliseconds as text with decimals, as a double and as a decimal."""
    ev = _events(spark, d)
    ms = T.epoch_ms(F.col("ts"))
    text = F.concat(ms.cast("string"), F.when(F.col("event_id") % 2 == 0, F.lit(".0")).otherwise(F.lit(".75")))
    return ev.select(
        "event_id",
        local_event_time_from_epoch_ms(text).alias("from_text"),
        F.to_date(local_event_time_from_epoch_ms(ms.cast("double"))).alias("from_double"),
        F.to_date(local_event_time_from_epoch_ms(ms.cast("decimal(20,3)"))).alias("from_decimal"),
    )


def date_text_day(spark, d):
    """[E14] date-only text is midnight UTC in any session zone; with a time and an
    offset it is an instant."""
    ev = _events(spark, d)
    day = F.date_format(F.col("ts").cast("date"), "yyyy-MM-dd")
    text = StringType()
    return ev.select(
        "event_id",
        local_event_time(day, text).alias("from_day"),
        local_event_time(F.concat(day, F.lit("T20:15:00-07:00")), text).alias("from_offset"),
        local_event_time(F.concat(day, F.lit(" 20:15:00")), text).alias("from_plain"),
    )


# ---- A / U: aggregations -------------------------------------------------------
def _wa_rows(spark, d):
    ev = _events(spark, d)
    local = local_event_time(F.col("ts"), ev.schema["ts"].dataType)
    status = T.pick(T.WHATSAPP_STATUSES, F.col("event_id"))
    return ev.select(
        "user_id",
        F.get_json_object("props", "$.k").alias("campaignid"),
        EV.canonical_event(status, EV.WHATSAPP_ENGAGEMENT, EV.PASSTHROUGH).alias("canonical_event"),
        local.alias("event_ts_local"),
        (F.col("value") > 50).alias("high_value"),
        "event_type",
    )


def first_event_dedup_query(spark, d):
    """[A1 A9] first time per user x campaign x event; max of a boolean and a string."""
    return first_event_dedup(
        _wa_rows(spark, d), ["campaignid"], "user_id", "canonical_event", "event_ts_local",
        ["high_value", "event_type"],
    )


def lead_flags_query(spark, d):
    """[A2 A7] per campaign x user: first time, its day, max of 0/1 flags."""
    ev = F.col("canonical_event")
    return lead_flags_op(_wa_rows(spark, d), ["campaignid"], "user_id", "event_ts_local", {
        "has_read": flag_if(ev == "read"),
        "has_click": flag_if(ev == "click"),
    }).select("campaignid", "user_id", "first_event_ts", "event_date", "has_read", "has_click")


def whatsapp_funnel(spark, d):
    """[M5 A3 A4 J6 J8 J10 E9 E15 E16] the WhatsApp funnel end to end."""
    ev = _events(spark, d)
    return whatsapp_engagement(
        T.whatsapp_logs(ev), T.campaigns(T.table(spark, d, "part")), T.lead_dim(T.table(spark, d, "customer"), T.table(spark, d, "orders"))
    )


def sms_funnel(spark, d):
    """[M4 A3 J5 J7 J10 E3 E8 E13 E14 E16] the SMS funnel end to end."""
    ev = _events(spark, d)
    return sms_engagement(
        T.sms_logs(ev), T.campaigns(T.table(spark, d, "part")), T.lead_dim(T.table(spark, d, "customer"), T.table(spark, d, "orders"))
    )


def funnels_as_stored(spark, d):
    """[J7 J8] both funnels with the numbers compared as the tables hold them."""
    ev, dim = _events(spark, d), T.lead_dim(T.table(spark, d, "customer"), T.table(spark, d, "orders"))
    camps = T.campaigns(T.table(spark, d, "part"))
    columns = ["campaignid", "event_date", "total_unique_leads", "site_visit_scheduled_any_unique", "booked_any_unique"]
    sms = sms_engagement(T.sms_logs(ev), camps, dim, phone_rule="as_stored")
    return union_channels(
        sms.select(F.lit("sms").alias("channel"), *columns),
        whatsapp_engagement(T.whatsapp_logs(ev), camps, dim, phone_rule="as_stored").select(F.lit("whatsapp").alias("channel"), *columns))


def union_channels_query(spark, d):
    """[U1 P5] three channel frames with different column orders, union by name."""
    ev = _events(spark, d)
    base = ev.select("event_id", "event_type", T.org_of(F.col("user_id")).alias("orgId"))
    sms = base.where(F.col("event_type").isin(*T.SMS_EVENT_TYPES)).select(
        "event_id", "orgId", T.pick(T.SMS_STATUSES, F.col("event_id")).alias("status"), F.lit("sms").alias("channel"))
    wa = base.where(F.col("event_type").isin(*T.WHATSAPP_EVENT_TYPES)).select(
        F.lit("whatsapp").alias("channel"), T.pick(T.WHATSAPP_STATUSES, F.col("event_id")).alias("status"), "orgId", "event_id")
    em = base.where(F.col("event_type").isin(*T.EMAIL_EVENT_TYPES)).select(
        "orgId", F.lit("email").alias("channel"), "event_id", T.pick(T.EMAIL_STATUSES, F.col("event_id")).alias("status"))
    return union_channels(sms, wa, em).select("event_id", "channel", "status", "orgId")


def _response_events(spark, d):
    ev = _events(spark, d)
    return union_channels(
        channel_events(T.sms_webhooks(ev), "sms", "updatedAt", EV.SMS_RESPONSE),
        channel_events(T.whatsapp_webhooks(ev), "whatsapp", "updatedAt", EV.WHATSAPP_RESPONSE, project_from_payload=True),
        channel_events(T.email_webhooks(ev), "email", "createdAt", EV.EMAIL_RESPONSE),
    )


def channel_pivot_query(spark, d):
    """[A5 A6] per day x org x project x profile, 16 channel metrics; NULL where a
    channel has no rows, 0 where it has rows but none of that event."""
    return channel_pivot(_response_events(spark, d), ["event_date", "orgId", "projectId", "profileId"],
                         "channel", "canonical_event", RESPONSE_COLUMNS)


def campaign_response(spark, d):
    """[M6 J9 C4] responses joined to the (deduplicated) lead dimension."""
    ev = _events(spark, d)
    return campaign_response_plan(
        T.sms_webhooks(ev), T.whatsapp_webhooks(ev), T.email_webhooks(ev),
        T.lead_dim(T.table(spark, d, "customer"), T.table(spark, d, "orders")),
    )


# ---- M: whole jobs ---------------------------------------------------------------
# arrays (carried as they are by the jobs) are compared as their JSON text
def lead_flat(spark, d):
    """[M1 C2 C3 P1 P3] leads bronze -> all 56 flat columns."""
    return lead_flat_plan(T.leads_bronze(T.table(spark, d, "customer")))


def comm_logs_flat(spark, d):
    """[M2 C5 C6 P1 P2 P8] log payload JSON -> all 109 columns."""
    return complex_to_json(communication_logs_flat(T.comm_logs_bronze(T.table(spark, d, "orders"))))


def lead_360_inputs(spark, d):
    """What M3 reads, as lazy plans over the test tables."""
    return (
        lead_flat_plan(T.leads_bronze(T.table(spark, d, "customer"))),
        communication_logs_flat(T.comm_logs_bronze(T.table(spark, d, "orders"))),
        T.projects(T.table(spark, d, "region")),
        T.entity_labels(T.table(spark, d, "nation")),
    )


def _namespace(spark) -> str:
    """A namespace of its own for a run, whose tables lie in the shared folder."""
    run = uuid.uuid4().hex
    ensure_namespace(spark, f"leadlake_check_{run}", f"{scratch_dir(spark)}/leadlake_tables/{run}")
    return f"leadlake_check_{run}"


def _write_bronze(rows: DataFrame, documents: Callable[[DataFrame], DataFrame], path: str) -> None:
    """The documents are some hundred times as large as the rows they are made of: the rows are
    dealt out first, as a file of few row groups would keep most cores idle, and JSON text is
    worth a denser codec."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    documents(rows.repartition(parts)).write.option("compression", "zstd").parquet(path)


def _job_tables(spark, d) -> tuple[str, dict[str, int]]:
    """M1 and M2 run as jobs, from bronze files to tables; their namespace and row counts."""
    ns, bronze = _namespace(spark), f"{scratch_dir(spark)}/leadlake_bronze/{uuid.uuid4().hex}"
    _write_bronze(T.table(spark, d, "customer"), T.leads_bronze, f"{bronze}/leads")
    _write_bronze(T.table(spark, d, "orders"), T.comm_logs_bronze, f"{bronze}/logs")
    return ns, {
        "lead_flat": jobs.run_lead_flat(spark, f"{bronze}/leads", f"{ns}.lead_flat")["rows"],
        "comm_logs": jobs.run_communication_logs(spark, f"{bronze}/logs", f"{ns}.comm_logs")["rows"],
    }


def _lead_360(spark, d, ns: str) -> DataFrame:
    return jobs.lead_360_of(
        spark, f"{ns}.lead_flat", f"{ns}.comm_logs", T.projects(T.table(spark, d, "region")),
        T.entity_labels(T.table(spark, d, "nation")))


def lead_360(spark, d):
    """[M3 J1-J4 P4 P7 P8 E1-E6] the wide lead dimension, all 163 columns, by the plan of its
    job over the tables that the jobs M1 and M2 wrote."""
    ns, _ = _job_tables(spark, d)
    return complex_to_json(_lead_360(spark, d, ns))


# ---- S: sinks -----------------------------------------------------------------------
def table_replace_roundtrip(spark, d):
    """[S2 S3 S4] full refresh: replace a catalog table twice (order labels, then campaigns
    derived from parts, with another schema) and read it back; the second content must win.
    The tables lie under the cluster's ``spark.checkpoint.dir``."""
    name = f"{_namespace(spark)}.entity_labels"
    orders = T.table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("_id"),
        T.org_of(F.col("o_orderkey")).alias("orgId"),
        F.col("o_orderpriority").alias("labelName"),
    )
    replace_table(orders, name)
    replace_table(T.campaigns(T.table(spark, d, "part")), name)
    return read_table(spark, name)


def table_replace_failed_write(spark, d):
    """[S3] a refresh that fails midway, after some of its tasks have written: readers still
    see the whole first content."""
    name = f"{_namespace(spark)}.orders"
    orders = T.table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    replace_table(orders, name, partition_by=["o_orderstatus"])
    k = F.col("o_orderkey")
    broken = orders.withColumn("o_orderkey", F.when(k % 1000 == 0, F.raise_error(F.lit("cut off")).cast("long")).otherwise(-k))
    try:
        replace_table(broken, name)
    except Exception as error:
        if "cut off" not in str(error):
            raise
        return read_table(spark, name).select("o_orderkey", "o_orderstatus")
    raise AssertionError("the second write did not fail")


def job_row_counts(spark, d):
    """[A8] rows of each silver table, observed while its job wrote it: no output is computed
    again to be counted."""
    ns, counts = _job_tables(spark, d)
    counts["lead_360"] = replace_table(_lead_360(spark, d, ns), f"{ns}.lead_360")["rows"]
    return spark.createDataFrame(list(counts.items()), "table_name string, row_count long")


QUERIES: dict[str, Query] = {
    "json_struct_flatten": json_struct_flatten,
    "json_path_extract": json_path_extract,
    "missing_column_guard": missing_column_guard,
    "complex_to_json": complex_to_json_query,
    "variant_flatten": variant_flatten,
    "bronze_drift": bronze_drift,
    "left_join_composite": left_join_composite,
    "left_join_hot_keys": left_join_hot_keys,
    "bucketed_join": bucketed_join,
    "role_lookups_one_shuffle": role_lookups_one_shuffle,
    "lookup_single_composite": lookup_single_composite,
    "role_playing_lookup": role_playing_lookup,
    "lookup_from_optional_side": lookup_from_optional_side,
    "computed_key_join": computed_key_join,
    "json_key_join": json_key_join,
    "left_then_not_null": left_then_not_null,
    "phone_normalise": phone_normalise,
    "presence_flag": presence_flag,
    "booking_flags": booking_flags,
    "json_temperature": json_temperature,
    "canonical_event_sms": canonical_event_sms,
    "canonical_event_whatsapp": canonical_event_whatsapp,
    "canonical_event_email": canonical_event_email,
    "raw_status_fallback": raw_status_fallback,
    "call_connected": call_connected_query,
    "local_event_day": local_event_day,
    "epoch_ms_day": epoch_ms_day,
    "struct_input_flatten": struct_input_flatten,
    "epoch_ms_decimal_day": epoch_ms_decimal_day,
    "date_text_day": date_text_day,
    "first_event_dedup": first_event_dedup_query,
    "lead_flags": lead_flags_query,
    "whatsapp_funnel": whatsapp_funnel,
    "sms_funnel": sms_funnel,
    "funnels_as_stored": funnels_as_stored,
    "union_channels": union_channels_query,
    "channel_pivot": channel_pivot_query,
    "campaign_response": campaign_response,
    "lead_flat": lead_flat,
    "comm_logs_flat": comm_logs_flat,
    "lead_360": lead_360,
    "table_replace_roundtrip": table_replace_roundtrip,
    "table_replace_failed_write": table_replace_failed_write,
    "job_row_counts": job_row_counts,
}
