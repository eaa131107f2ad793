"""The funnels against plain-Python sets of leads, on random rows with hot keys, shared
phones, duplicate campaigns and several dimension rows per lead."""

import datetime as dt
import json
import random
from collections import defaultdict

import pytest

from conftest import rows
from pyspark.sql import functions as F

from leadlake.plans.engagement import SMS_OUTPUT, WHATSAPP_OUTPUT, sms_engagement, whatsapp_engagement

DAY = 86_400_000
T0 = 1704067200000


def _data(spark, seed=5):
    rnd = random.Random(seed)
    phones = [f"90000000{i:02d}" for i in range(20)]
    spell = [lambda p: p, lambda p: "+91 " + p, lambda p: "91" + p, lambda p: p[:5] + " " + p[5:]]
    dim = []
    for i in range(40):
        p = phones[0] if i < 8 else rnd.choice(phones)            # 8 leads share the hot number
        for _ in range(rnd.randrange(1, 4)):                        # lead x log fan-out
            dim.append((f"L{i}", f"o{i % 2}", rnd.choice(spell)(p) if rnd.random() > 0.05 else None,
                        rnd.choice([True, False, None]), rnd.choice(["2024-02-01", None]),
                        rnd.choice(["b", None]), rnd.choice(["Booked", "open", None])))
    logs = []
    for j in range(900):
        p = phones[0] if j % 3 == 0 else rnd.choice(phones)        # a third of the logs on one number
        logs.append((rnd.choice(["c1", "c2", "c3", None]), f"o{rnd.randrange(2)}",
                     rnd.choice(["read", "Seen", "click", "URL_CLICK", "delivered", "queued", None]),
                     json.dumps({"recipient": {"to": "+91" + p}, "events": {"timestamp": T0 + rnd.randrange(4 * DAY)}})))
    camps = [("c1", "o0", "A", "wa"), ("c1", "o0", "A2", "wa"), ("c2", "o1", "B", "wa")]   # c1/o0 duplicated
    return (
        spark.createDataFrame(logs, "campaignId string, organisationId string, status string, payload string"),
        spark.createDataFrame(camps, "_id string, organisationId string, name string, channel string"),
        spark.createDataFrame(dim, "leadId string, orgId string, profile_whatsAppNumber string, "
                                   "site_visit_scheduled boolean, siteVisit_date string, bookingId string, "
                                   "sirrus_lead_status string"),
    )


def _national(text):
    """Digits of a number without the country code; None when there are none."""
    d = "".join(c for c in text or "" if c in "0123456789")
    return (d[2:] if len(d) > 10 and d.startswith("91") else d) or None


class Seen:
    """What one lead did in one campaign."""

    def __init__(self):
        self.times, self.events, self.marks = [], set(), set()


def _counts(seen, counted):
    """Rows (key..., day, leads, one count per condition) from {key: {lead: Seen}}."""
    days = defaultdict(set)
    for key, leads in seen.items():
        for lead, s in leads.items():
            days[key + (min(s.times).date(),)].add(lead)
    out = []
    for key, leads in days.items():
        each = [seen[key[:-1]][lead] for lead in leads]
        out.append(key + (len(each),) + tuple(sum(bool(f(s)) for s in each) for f in counted))
    return sorted(out, key=repr)


def _marks(row):
    """The lead-level facts that one dimension row states."""
    found = set()
    if row.site_visit_scheduled:
        found.add("scheduled")
    if row.siteVisit_date is not None:
        found.add("visited")
    if row.bookingId is not None and (row.sirrus_lead_status or "").lower() == "booked":
        found.add("booked")
    return found


LEAD_COUNTS = [lambda s, m=m: m in s.marks for m in ("scheduled", "visited", "booked")]
EVENTS = {"read": "read", "seen": "read", "message_read": "read", "click": "click", "url_click": "click",
          "delivered": "delivered", "deliv": "delivered"}


def test_whatsapp_funnel_equals_sets_of_leads(spark):
    logs, camps, dim = _data(spark)
    campaigns, people = defaultdict(list), defaultdict(list)
    for c in camps.collect():
        campaigns[c._id, c.organisationId].append((c.name, c.channel))
    for d in dim.collect():
        people[_national(d.profile_whatsAppNumber), d.orgId].append(d)
    seen = defaultdict(lambda: defaultdict(Seen))
    for g in logs.collect():
        number = _national(json.loads(g.payload)["recipient"]["to"])
        if g.campaignId is None or number is None:
            continue
        at = dt.datetime(1970, 1, 1) + dt.timedelta(
            milliseconds=json.loads(g.payload)["events"]["timestamp"], minutes=330)
        for name, channel in campaigns.get((g.campaignId, g.organisationId), [(None, None)]):
            for d in people[number, g.organisationId]:
                s = seen[g.campaignId, name, channel, g.organisationId][d.leadId]
                s.times.append(at)
                s.events.add(EVENTS.get((g.status or "").lower()))
                s.marks |= _marks(d)
    want = _counts(seen, [
        lambda s: "read" in s.events, lambda s: "click" in s.events, lambda s: {"read", "click"} <= s.events,
        lambda s: "read" in s.events and "click" not in s.events,
        lambda s: "click" in s.events and "read" not in s.events,
        lambda s: "delivered" in s.events, *LEAD_COUNTS])
    mine = whatsapp_engagement(logs, camps, dim)
    assert mine.columns == WHATSAPP_OUTPUT
    assert len(want) > 5 and rows(mine, *WHATSAPP_OUTPUT) == want


def test_shared_number_across_many_leads_is_split_by_aqe(spark):
    """A third of all leads share one (placeholder) number: the lead join of the
    funnel is an inner join, so AQE can split that hot key on the lead side."""
    from test_operators import SKEW_CONF

    n = 6000
    dim = spark.range(n).select(
        F.concat(F.lit("L"), F.col("id").cast("string")).alias("leadId"), F.lit("o1").alias("orgId"),
        F.when(F.col("id") % 3 == 0, F.lit("9000000000"))
        .otherwise((F.lit(9100000000) + F.col("id")).cast("string")).alias("profile_whatsAppNumber"),
        F.lit(None).cast("boolean").alias("site_visit_scheduled"), F.lit(None).cast("string").alias("siteVisit_date"),
        F.lit(None).cast("string").alias("bookingId"), F.lit(None).cast("string").alias("sirrus_lead_status"),
        F.repeat(F.lit("x"), 60).alias("pad"))
    logs = spark.range(n).select(
        F.lit("c1").alias("campaignId"), F.lit("o1").alias("organisationId"), F.lit("read").alias("status"),
        F.to_json(F.struct(
            F.struct(F.when(F.col("id") % 3 == 0, F.lit("9000000000"))
                     .otherwise((F.lit(9100000000) + F.col("id")).cast("string")).alias("to")).alias("recipient"),
            F.struct(F.lit(str(T0)).alias("timestamp")).alias("events"))).alias("payload"))
    camps = spark.createDataFrame([("c1", "o1", "A", "wa")], "_id string, organisationId string, name string, channel string")
    prev = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        df = whatsapp_engagement(logs, camps, dim)
        got = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in prev.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert [(r.total_unique_leads, r.whatsapp_read_unique) for r in got] == [(n, n)]
    assert "skew=true" in plan


def _sms_data(spark, seed=9):
    rnd = random.Random(seed)
    phones = [f"90000000{i:02d}" for i in range(15)]
    dim = []
    for i in range(30):
        p = phones[0] if i < 6 else rnd.choice(phones)
        for _ in range(rnd.randrange(1, 4)):
            dim.append((f"L{i}", f"o{i % 2}", rnd.choice([p, "+91 " + p, None]),
                        rnd.choice([True, None]), rnd.choice(["d", None]), rnd.choice(["b", None]),
                        rnd.choice(["BOOKED", "x"]), rnd.choice(["1m 20s", "0", None, "1.2.3"]),
                        rnd.choice(["Answered", "busy", None])))
    logs = []
    for j in range(700):
        p = phones[0] if j % 3 == 0 else rnd.choice(phones)
        logs.append((f"s{j}", rnd.choice(["c1", "c2", None]), rnd.choice([p, "91" + p, "+91-" + p]),
                     rnd.choice(['{"status":{"code":200}}', '{"status":{"code":"500","desc":"Accepted"}}', None]),
                     rnd.choice(["DELIVERY", "submit", None]),
                     f"2024-01-0{rnd.randrange(1, 4)} {rnd.randrange(24):02d}:00:00", f"o{rnd.randrange(2)}"))
    return (
        spark.createDataFrame(logs, "_id string, campaignId string, to string, providerResponse string, type string, "
                                    "createdAt string, organisationId string"),
        spark.createDataFrame([("c1", "o0", "A", "sms"), ("c2", "o1", "B", "sms")],
                              "_id string, organisationId string, name string, channel string"),
        spark.createDataFrame(dim, "leadId string, orgId string, profile_whatsAppNumber string, "
                                   "site_visit_scheduled boolean, siteVisit_date string, bookingId string, "
                                   "sirrus_lead_status string, callDuration string, callStatus string"),
    )


def _call_worked(row):
    digits = "".join(c for c in (row.callDuration or "0") if c in "0123456789.")
    try:
        talked = float(digits) > 0
    except ValueError:
        talked = False
    return talked or (row.callStatus or "").lower() in {"connected", "answered", "completed", "in-progress"}


def _sms_arrived(g):
    status = json.loads(g.providerResponse)["status"] if g.providerResponse else {}
    return (str(status.get("code")) == "200" or "accept" in status.get("desc", "").lower()
            or (g.type or "").lower() in {"delivered", "delivery"})


@pytest.mark.parametrize("with_org", [False, True])
def test_sms_funnel_equals_sets_of_leads(spark, with_org):
    logs, camps, dim = _sms_data(spark)
    names = {c._id: (c.name, c.channel) for c in camps.collect()}
    people = defaultdict(list)
    for d in dim.collect():
        people[_national(d.profile_whatsAppNumber)].append(d)
    seen = defaultdict(lambda: defaultdict(Seen))
    for g in logs.collect():
        number = _national(g.to)
        if g.campaignId is None or number is None:
            continue
        at = dt.datetime.fromisoformat(g.createdAt) + dt.timedelta(minutes=330)
        for d in people[number]:
            if with_org and d.orgId != g.organisationId:
                continue
            s = seen[(g.campaignId, *names[g.campaignId])][d.leadId]
            s.times.append(at)
            s.marks |= _marks(d)
            if _sms_arrived(g):
                s.events.add("arrived")
            if _call_worked(d):
                s.marks.add("called")
    want = _counts(seen, [lambda s: "arrived" in s.events, lambda s: "called" in s.marks, *LEAD_COUNTS])
    mine = sms_engagement(logs, camps, dim, org_column="organisationId" if with_org else None)
    assert len(want) >= 2 and rows(mine, *SMS_OUTPUT) == want


def test_as_stored_phone_rule_compares_numbers_as_the_tables_hold_them(spark):
    dim = spark.createDataFrame(
        [("L1", "o", "9000000001"), ("L2", "o", "+91 9000000002"), ("L3", "o", "919000000003")],
        "leadId string, orgId string, profile_whatsAppNumber string").selectExpr(
        "*", "cast(null as boolean) site_visit_scheduled", "cast(null as string) siteVisit_date",
        "cast(null as string) bookingId", "cast(null as string) sirrus_lead_status",
        "cast(null as string) callDuration", "cast(null as string) callStatus")
    camps = spark.createDataFrame([("c", "o", "A", "x")], "_id string, organisationId string, name string, channel string")
    numbers = ["919000000001", "9000000002", "+919000000003"]
    sms = spark.createDataFrame(
        [("c", n, "2024-01-01 00:00:00", str(k)) for k, n in enumerate(numbers)],
        "campaignId string, to string, createdAt string, _id string")
    wa = spark.createDataFrame(
        [("c", "o", "read", json.dumps({"recipient": {"to": n}, "events": {"timestamp": T0}})) for n in numbers],
        "campaignId string, organisationId string, status string, payload string")

    def leads(df):
        return sum(r.total_unique_leads for r in df.collect())

    assert leads(sms_engagement(sms, camps, dim)) == leads(whatsapp_engagement(wa, camps, dim)) == 3
    # stored SMS form is 9000000001 / 9000000002 / 9000000003: only the plain log number finds its lead
    assert leads(sms_engagement(sms, camps, dim, phone_rule="as_stored")) == 1
    # raw WhatsApp number: only 919000000003 is written as plain digits in both
    assert leads(whatsapp_engagement(wa, camps, dim, phone_rule="as_stored")) == 1
