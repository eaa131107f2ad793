"""Property tests: the phone and presence rules in Spark against the same rules
written in plain Python, on generated inputs (one Spark job per property)."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leadlake.functions.text import is_present, normalize_phone, phone_key

PHONEISH = st.text(alphabet="0123456789+- ()\t", min_size=0, max_size=24)
TEXTISH = st.one_of(st.none(), PHONEISH, st.sampled_from(["None", "  ", "\t\n", "{}", "null", "x"]))


def py_normalize(raw, cc="91"):
    if raw is None:
        return None
    d = re.sub(r"[^0-9]", "", raw)
    if d.startswith(cc) and len(raw) > 10:
        return d[len(cc):]
    if raw.startswith("+" + cc):
        return raw[len(cc) + 1:]
    if raw.startswith(cc) and len(raw) > 10:      # the branch the Spark form leaves out
        return raw[len(cc):]
    if raw.startswith("+"):
        return raw[1:]
    return raw


def py_phone_key(raw, cc="91"):
    if raw is None:
        return None
    d = re.sub(r"[^0-9]", "", raw)
    if d == "":
        return None
    return d[len(cc):] if len(d) > 10 and d.startswith(cc) else d


def py_present(v):
    return v is not None and re.sub(r"\s+", "", v) != "" and v != "None"


@settings(max_examples=5, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), PHONEISH), min_size=50, max_size=200))
def test_phone_rules_match_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select("v", normalize_phone(F.col("v")).alias("n"), phone_key(F.col("v")).alias("k")).collect()
    for r in got:
        assert (r.n, r.k) == (py_normalize(r.v), py_phone_key(r.v)), r.v


@settings(max_examples=5, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(TEXTISH, min_size=50, max_size=200))
def test_presence_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for r in df.select("v", is_present(F.col("v")).alias("p")).collect():
        assert r.p == py_present(r.v), repr(r.v)


# ---- event mappings and call rule ---------------------------------------------------
from leadlake.functions import events as EV  # noqa: E402
from leadlake.functions.flags import call_connected  # noqa: E402

MAPPINGS = [(EV.WHATSAPP_ENGAGEMENT, EV.PASSTHROUGH), (EV.SMS_RESPONSE, None),
            (EV.SMS_RESPONSE_CORRECTED, None), (EV.WHATSAPP_RESPONSE, None), (EV.EMAIL_RESPONSE, None)]
VOCAB = sorted({v for rules, _ in MAPPINGS for _, _, vals in rules for v in vals})


def _variants(v):
    return st.sampled_from([v, v.lower(), v.upper(), v.title(), v + " ", "x" + v])


STATUS = st.one_of(st.none(), st.sampled_from(VOCAB).flatmap(_variants),
                   st.text(alphabet="abcdeFGHIJ-_ ", max_size=8))


def py_canonical(status, rules, default):
    if status is None:
        return None
    for event, fold, values in rules:
        if (status.upper() if fold == "upper" else status.lower()) in values:
            return event
    if default == EV.PASSTHROUGH:
        return status.lower()
    return default


@settings(max_examples=5, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(STATUS, min_size=50, max_size=200))
def test_event_mappings_match_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    cols = [EV.canonical_event(F.col("v"), rules, d).alias(f"m{i}") for i, (rules, d) in enumerate(MAPPINGS)]
    for r in df.select("v", *cols).collect():
        for i, (rules, d) in enumerate(MAPPINGS):
            assert r[f"m{i}"] == py_canonical(r.v, rules, d), (i, r.v)


def py_connected(duration, status):
    cleaned = re.sub(r"[^0-9.]", "", duration if duration is not None else "0")
    try:
        by_duration = float(cleaned) > 0 if cleaned not in ("", ".") else False
    except ValueError:
        by_duration = False
    return 1 if by_duration or (status or "").lower() in ("connected", "answered", "completed", "in-progress") else 0


DURATION = st.one_of(st.none(), st.text(alphabet="0123456789.:ms ", max_size=8))
CALL_STATUS = st.one_of(st.none(), st.sampled_from(["Answered", "COMPLETED", "in-progress", "busy", "", "connected "]))


@settings(max_examples=5, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(DURATION, CALL_STATUS), min_size=50, max_size=200))
def test_call_connected_matches_python(spark, values):
    df = spark.createDataFrame(values, "d string, s string")
    for r in df.select("d", "s", call_connected(F.col("d"), F.col("s")).alias("c")).collect():
        assert r.c == py_connected(r.d, r.s), (r.d, r.s)


# ---- local time --------------------------------------------------------------------
import datetime as dt  # noqa: E402
from zoneinfo import ZoneInfo  # noqa: E402

from pyspark.sql.types import StringType  # noqa: E402

from leadlake.functions.time import local_event_time  # noqa: E402

KOLKATA = ZoneInfo("Asia/Kolkata")
WALL = st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2040, 1, 1))
OFFSET = st.sampled_from(["Z", "+00:00", "+05:30", "-07:00", "+09:00"])


def py_local(wall_utc: dt.datetime) -> dt.datetime:
    return wall_utc.replace(tzinfo=dt.timezone.utc).astimezone(KOLKATA).replace(tzinfo=None)


@settings(max_examples=5, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(WALL, OFFSET), min_size=50, max_size=150))
def test_local_time_matches_zoneinfo_in_any_session_zone(spark, values):
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")   # has DST: must not matter
    try:
        rows = [(w.replace(microsecond=0), w.replace(microsecond=0).isoformat(sep=" "),
                 w.replace(microsecond=0).isoformat() + off, off, w.date().isoformat()) for w, off in values]
        df = spark.createDataFrame(rows, "w timestamp_ntz, plain string, zoned string, off string, day string")
        got = df.select(
            "w", "off",
            local_event_time(F.col("w"), df.schema["w"].dataType).alias("a"),
            local_event_time(F.col("plain"), StringType()).alias("b"),
            local_event_time(F.col("zoned"), StringType()).alias("c"),
            local_event_time(F.col("day"), StringType()).alias("d"),
        ).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    for r in got:
        assert r.a == r.b == py_local(r.w), r.w
        assert r.d == py_local(dt.datetime.combine(r.w.date(), dt.time())), r.w
        instant = dt.datetime.fromisoformat(r.w.isoformat() + r.off.replace("Z", "+00:00"))
        assert r.c == instant.astimezone(KOLKATA).replace(tzinfo=None), (r.w, r.off)
