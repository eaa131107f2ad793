"""E1-E16, F2, X9-X15 on literal rows (expected values from FIXTURES.md section 3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from leadlake.functions import events as EV
from leadlake.functions.flags import (
    booked_date,
    booked_flag,
    call_connected,
    lead_temperature,
    null_to_false,
    site_visit_completed,
    site_visit_scheduled,
    sms_raw_status,
)
from leadlake.functions.text import is_present, normalize_phone, phone_key
from leadlake.functions.time import local_event_time, local_event_time_from_epoch_ms


def _one_col(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {dtype}")


PHONES = [
    ("+91 98765-43210", "9876543210", "9876543210"),
    ("919876543210", "9876543210", "9876543210"),
    ("+919876", "9876", "919876"),
    ("91234-56789", "23456789", "9123456789"),
    ("+1 415 555 0100", "1 415 555 0100", "14155550100"),
    ("98765 43210", "98765 43210", "9876543210"),
    ("", "", None),
    (None, None, None),
]


def test_normalize_phone_and_phone_key(spark):
    df = _one_col(spark, [p for p, _, _ in PHONES])
    got = {r["v"]: (r["n"], r["k"]) for r in df.select(
        "v", normalize_phone(F.col("v")).alias("n"), phone_key(F.col("v")).alias("k")).collect()}
    for raw, norm, key in PHONES:
        assert got[raw] == (norm, key), raw


def test_presence(spark):
    cases = {"None": False, "  ": False, None: False, "{}": True, "null": True, "\t\n": False, "x": True}
    df = _one_col(spark, list(cases))
    got = {r["v"]: r["p"] for r in df.select("v", is_present(F.col("v")).alias("p")).collect()}
    assert got == cases


def test_site_visit_scheduled_chain(spark):
    df = spark.createDataFrame(
        [("{}", None, None), ("None", "2024-01-01", None), ("  ", "None", "x"), (None, " ", None), (None, None, None)],
        "j string, n string, f string",
    )
    got = [r[0] for r in df.select(site_visit_scheduled(F.col("j"), F.col("n"), F.col("f"))).collect()]
    assert got == [True, True, True, False, False]


def test_booking_flags(spark):
    df = spark.createDataFrame(
        [("b1", "Booked", "2024-01-01"), ("b2", "open", "2024-01-02"), (None, "BOOKED", "2024-01-03"), ("b4", None, "x")],
        "b string, l string, c string",
    )
    got = df.select(booked_flag(F.col("b"), F.col("l")).alias("f"),
                    booked_date(F.col("b"), F.col("l"), F.col("c")).alias("d")).collect()
    assert [(r.f, r.d) for r in got] == [(1, "2024-01-01"), (0, None), (0, None), (0, None)]


def test_site_visit_completed_and_null_to_false(spark):
    df = _one_col(spark, ["SV_DONE", "sv_done", None])
    got = [r[0] for r in df.select(site_visit_completed(F.col("v"))).collect()]
    assert got == [True, False, False]
    b = _one_col(spark, [True, False, None], "boolean")
    assert [r[0] for r in b.select(null_to_false(F.col("v"))).collect()] == [True, False, False]


def test_lead_temperature_and_raw_status(spark):
    df = spark.createDataFrame(
        [('{"leadIntent":"Hot"}', '{"status":{"code":"200"}}', "T", '{"status":"S"}', "id1"),
         ("{bad", None, "Type", '{"status":"S"}', "id2"),
         (None, None, None, '{"status":"Pay"}', "id3"),
         (None, None, None, None, "ID4")],
        "c string, pr string, t string, p string, i string",
    )
    got = df.select(lead_temperature(F.col("c")).alias("lt"),
                    sms_raw_status(F.col("pr"), F.col("t"), F.col("p"), F.col("i")).alias("rs")).collect()
    assert [(r.lt, r.rs) for r in got] == [("Hot", "200"), (None, "type"), (None, "pay"), (None, "id4")]


@pytest.mark.parametrize("rules,default,cases", [
    (EV.WHATSAPP_ENGAGEMENT, EV.PASSTHROUGH,
     {"Seen": "read", "URL_CLICK": "click", "deliv": "delivered", "Queued": "queued", None: None}),
    (EV.SMS_RESPONSE, None,
     {"DELIVRD": "sent", "failed": "sent", "UNDELIV": "failed", "Click": "click", "xyz": None}),
    (EV.SMS_RESPONSE_CORRECTED, None,
     {"DELIVRD": "delivered", "failed": "failed", "UNDELIV": "failed", "submitd": "sent"}),
    (EV.WHATSAPP_RESPONSE, None,
     {"queued": "sent", "seen": "read", "replied": "reply", "xyz": None, "FAILED": "failed"}),
    (EV.EMAIL_RESPONSE, None,
     {"Bounced": "sent", "opened": "open", "SPAM": "spam", "unsubscribed": "unsubscribe", None: None}),
])
def test_canonical_event(spark, rules, default, cases):
    df = _one_col(spark, list(cases))
    got = {r["v"]: r["e"] for r in df.select("v", EV.canonical_event(F.col("v"), rules, default).alias("e")).collect()}
    assert got == cases


def test_sms_engagement_event(spark):
    df = spark.createDataFrame(
        [("200", None, None), ("500", "Accepted", None), (None, None, "DELIVERY"), (None, None, None), ("404", "no", "x")],
        "c string, d string, t string",
    )
    got = [r[0] for r in df.select(EV.sms_engagement_event(F.col("c"), F.col("d"), F.col("t"))).collect()]
    assert got == ["delivered", "delivered", "delivered", "other", "other"]


def test_call_connected(spark):
    df = spark.createDataFrame(
        [("1m 20s", None), ("00:45", None), ("0", None), ("", None), ("1.2.3", None), (None, "Answered"), (None, None)],
        "d string, s string",
    )
    got = [r[0] for r in df.select(call_connected(F.col("d"), F.col("s"))).collect()]
    assert got == [1, 1, 0, 0, 0, 1, 0]


def test_local_time_all_input_kinds(spark):
    text = _one_col(spark, ["2024-01-01T20:00:00Z", "2024-01-01 20:00:00", "x", "2024-01-01T20:00:00+05:30"])
    got = [r[0] for r in text.select(local_event_time(F.col("v"), StringType())).collect()]
    assert got == [dt.datetime(2024, 1, 2, 1, 30), dt.datetime(2024, 1, 2, 1, 30), None, dt.datetime(2024, 1, 1, 20, 0)]
    ntz = text.select(F.col("v").try_cast("timestamp_ntz").alias("v")).limit(2)
    got = [r[0] for r in ntz.select(local_event_time(F.col("v"), ntz.schema["v"].dataType)).collect()]
    assert got == [dt.datetime(2024, 1, 2, 1, 30)] * 2
    ms = _one_col(spark, ["1704067200000", "oops"])
    got = [r[0] for r in ms.select(local_event_time_from_epoch_ms(F.col("v"))).collect()]
    assert got == [dt.datetime(2024, 1, 1, 5, 30), None]


def test_local_time_ignores_session_zone(spark):
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = _one_col(spark, ["2024-01-01T20:00:00Z", "2024-01-01 20:00:00"])
        ltz = df.select(F.col("v").try_cast("timestamp").alias("v"))
        a = [r[0] for r in df.select(local_event_time(F.col("v"), StringType())).collect()]
        b = [r[0] for r in ltz.select(local_event_time(F.col("v"), ltz.schema["v"].dataType)).collect()]
        assert a == [dt.datetime(2024, 1, 2, 1, 30)] * 2
        # an instant is shifted once whatever the session zone
        assert b[0] == dt.datetime(2024, 1, 2, 1, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_from_json_permissive_rules(spark):
    schema = StructType([StructField("a", StringType()), StructField("b", BooleanType()),
                         StructField("l", ArrayType(StringType()))])
    df = _one_col(spark, ['{"a":{"z":1},"b":"true"}', '{"a":5,"b":true,"l":["p",2]}', "{bad", "[]", "null",
                          '{"A":1}', "", None])
    got = [r[0] for r in df.select(F.from_json("v", schema)).collect()]
    assert got[0].a == '{"z":1}' and got[0].b is None and got[0].l is None
    assert got[1].a == "5" and got[1].b is True and got[1].l == ["p", "2"]
    for s in got[2:6]:
        assert s is not None and s.a is None and s.b is None and s.l is None
    assert got[6] is None and got[7] is None
