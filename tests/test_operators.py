"""C2-C6, P1-P2, J1-J10, A1-A6, U1 on small DataFrames, plus equivalence checks."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from leadlake.functions.flags import flag_if
from leadlake.operators import (
    channel_pivot,
    complex_to_json,
    ensure_column,
    flatten,
    funnel_counts,
    lead_flags,
    left_join_one_to_many,
    lookup,
    parse_or_null,
    project_paths,
    role_lookups,
    safe_scalar,
    safe_struct,
    union_channels,
)

SCHEMA = StructType([StructField("x", StringType()), StructField("y", StringType())])


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- guards -------------------------------------------------------------------
def test_guards_missing_and_present(spark):
    df = spark.createDataFrame([(1, '{"x":"a"}')], "id int, j string")
    out = df.select(
        safe_struct(df, "j", SCHEMA).alias("s"),
        safe_struct(df, "absent", SCHEMA).alias("s2"),
        safe_scalar(df, "id").alias("id_s"),
        safe_scalar(df, "absent").alias("none_s"),
    ).collect()[0]
    assert out.s.x == "a" and out.s.y is None and out.s2 is None
    assert out.id_s == "1" and out.none_s is None
    e = ensure_column(ensure_column(df, "p", IntegerType()), "id", StringType())
    assert dict(e.dtypes) == {"id": "int", "j": "string", "p": "int"}


def test_parse_or_null(spark):
    df = spark.createDataFrame([("a", '{"x":"1"}')], "k string, payload string")
    assert parse_or_null(df, "payload", SCHEMA).collect()[0].payload.x == "1"
    nop = spark.createDataFrame([("a",)], "k string")
    p = parse_or_null(nop, "payload", SCHEMA)
    assert p.schema["payload"].dataType == SCHEMA and p.collect()[0].payload is None


def test_complex_to_json(spark):
    df = spark.createDataFrame([(1, ["a"], {"k": 1}, ("s", 2))], "i int, a array<string>, m map<string,int>, s struct<p:string,q:int>")
    out = complex_to_json(df)
    assert out.columns == ["i", "a", "m", "s"]
    r = out.collect()[0]
    assert (r.i, r.a, r.m, r.s) == (1, '["a"]', '{"k":1}', '{"p":"s","q":2}')


# ---- projections --------------------------------------------------------------
def test_flatten_and_paths(spark):
    df = spark.createDataFrame([(("a", ("m", "y")),)], "s struct<f:string, d:struct<month:string, year:string>>")
    assert df.select(*flatten("s", "pre", ["f"])).columns == ["pre_f"]
    out = project_paths(df, [("deep", "s.d.month"), ("f", "s.f")]).collect()[0]
    assert (out.deep, out.f) == ("m", "a")


# ---- joins --------------------------------------------------------------------
def test_lookup_composite_roles_and_no_ambiguity(spark):
    fact = spark.createDataFrame(
        [("l1", "o1", "S1", "S2", "S3"), ("l2", "o2", "S1", None, "S9")], "id string, org string, a string, b string, c string")
    labels = spark.createDataFrame(
        [("S1", "o1", "one"), ("S2", "o1", "two"), ("S3", "o1", "three"), ("S1", "o2", "uno")], "_id string, orgId string, labelName string")
    out = role_lookups(fact, labels, {
        "ra": ([("a", "_id"), ("org", "orgId")], {"labelName": "la"}),
        "rb": ([("b", "_id"), ("org", "orgId")], {"labelName": "lb"}),
        "rc": ([("c", "_id"), ("org", "orgId")], {"labelName": "lc"}),
    })
    assert rows(out, "id", "la", "lb", "lc") == [("l1", "one", "two", "three"), ("l2", "uno", None, None)]


def test_lookup_computed_key_and_duplicates_fan_out(spark):
    fact = spark.createDataFrame([("+91 98", 1), ("x", 2)], "to string, n int")
    dim = spark.createDataFrame([(9198, "a"), (9198, "b")], "k long, v string")
    out = lookup(fact, dim, [(F.regexp_replace("to", "[^0-9]", "").try_cast("long"), "k")], {"v": "v"})
    assert rows(out, "n", "v") == [(1, "a"), (1, "b"), (2, None)]


def test_building_lookups_starts_no_job(spark, tmp_path):
    """No size check runs while a plan is built; small sides are broadcast by Spark."""
    big, small = str(tmp_path / "big"), str(tmp_path / "small")
    spark.range(1000).withColumnRenamed("id", "k").write.parquet(big)
    spark.range(10).selectExpr("id as k2", "id as v").write.parquet(small)
    facts, dim = spark.read.parquet(big), spark.read.parquet(small)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "plans only")
    try:
        out = role_lookups(lookup(facts, dim, [("k", "k2")], {"v": "a"}), dim,
                           {"r": ([("k", "k2")], {"v": "b"})})
        plan = _plan(out)
        assert list(tracker.getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert plan.count("BroadcastHashJoin") == 2


def test_lookup_broadcasts_fixed_vocabularies_only_on_request(spark):
    small = spark.range(10).withColumnRenamed("id", "k2")
    big = spark.range(1000).withColumnRenamed("id", "k")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in _plan(lookup(big, small, [("k", "k2")], {"k2": "v"}, broadcast=True))
        assert "BroadcastHashJoin" not in _plan(lookup(big, small, [("k", "k2")], {"k2": "v"}))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_struct_columns_are_read_like_json_text(spark):
    text = spark.createDataFrame([(1, '{"x":"a","y":"b"}')], "id int, j string")
    native = spark.createDataFrame([(1, ("a", 5))], "id int, j struct<x:string,y:int>")
    assert text.select(safe_struct(text, "j", SCHEMA).alias("s")).collect()[0].s.x == "a"
    s = native.select(safe_struct(native, "j", SCHEMA).alias("s")).collect()[0].s
    assert (s.x, s.y) == ("a", "5")
    assert parse_or_null(native, "j", SCHEMA).collect()[0].j.x == "a"
    wrong = spark.createDataFrame([(1, 2.5)], "id int, j double")
    with pytest.raises(TypeError):
        safe_struct(wrong, "j", SCHEMA)


def test_left_join_one_to_many_matches_plain_left_join(spark):
    rnd = random.Random(7)
    leads = spark.createDataFrame(
        [(f"L{i}", f"o{i % 2}", None if i % 7 == 0 else "P") for i in range(40)], "id string, org string, proj string")
    # a hot lead holding a third of the logs, plus NULL keys on both sides
    logs = [("L1", "o1", "P", f"g{i}") for i in range(60)]
    logs += [(f"L{rnd.randrange(50)}", f"o{rnd.randrange(2)}", rnd.choice(["P", None]), f"h{i}") for i in range(120)]
    logs = spark.createDataFrame(logs, "leadId string, orgId string, projectId string, log string")
    on = [("id", "leadId"), ("org", "orgId"), ("proj", "projectId")]
    cols = {"log": "log", "leadId": "leadId_comm"}
    safe = left_join_one_to_many(leads, logs, on, cols, skew_safe=True)
    plain = left_join_one_to_many(leads, logs, on, cols, skew_safe=False)
    assert safe.columns == plain.columns == ["id", "org", "proj", "log", "leadId_comm"]
    assert rows(safe) == rows(plain)
    assert safe.where("id = 'L1' AND log LIKE 'g%'").count() == 60


# ---- aggregations -------------------------------------------------------------
def _random_events(spark, n=400, seed=11):
    rnd = random.Random(seed)
    data = []
    for _ in range(n):
        data.append((
            f"c{rnd.randrange(4)}", rnd.choice(["name", None]), f"u{rnd.randrange(30)}",
            rnd.choice(["read", "click", "delivered", "queued"]),
            f"2024-01-{rnd.randrange(1, 4):02d} {rnd.randrange(24):02d}:00:00",
            rnd.choice([True, False, None]), rnd.choice(["2024-02-01", None]), rnd.randrange(2),
        ))
    return spark.createDataFrame(data, "cid string, cname string, lead string, ev string, ts string, sv boolean, svd string, bk int") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_funnel_counts_leads_by_their_first_day(spark):
    ev = _random_events(spark)
    keys = ["cid", "cname"]
    e = F.col("ev")
    flags = {"r": flag_if(e == "read"), "k": flag_if(e == "click"), "b": F.col("bk")}
    out = funnel_counts(lead_flags(ev, keys, "lead", "ts", flags), keys, {
        "read_u": F.col("r") == 1, "both_u": (F.col("r") == 1) & (F.col("k") == 1), "b_u": F.col("b") == 1})
    by_lead = {}
    for x in ev.collect():
        by_lead.setdefault((x.cid, x.cname, x.lead), []).append(x)
    want = {}
    for (cid, cname, _), mine in by_lead.items():
        events = {x.ev for x in mine}
        cell = want.setdefault((cid, cname, min(x.ts for x in mine).date()), [0, 0, 0, 0])
        for k, met in enumerate((True, "read" in events, {"read", "click"} <= events, any(x.bk for x in mine))):
            cell[k] += met
    cols = ("cid", "cname", "event_date", "total_unique_leads", "read_u", "both_u", "b_u")
    assert rows(out, *cols) == sorted((k + tuple(v) for k, v in want.items()), key=repr)
    assert "Expand" not in _plan(out)


def test_cohort_day_is_first_event_day(spark):
    ev = spark.createDataFrame(
        [("c", "u1", "2024-01-01 10:00:00"), ("c", "u1", "2024-01-02 10:00:00"), ("c", "u2", "2024-01-02 10:00:00")],
        "cid string, lead string, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    out = funnel_counts(lead_flags(ev, ["cid"], "lead", "ts", {}), ["cid"], {})
    assert rows(out, "event_date", "total_unique_leads") == [
        (__import__("datetime").date(2024, 1, 1), 1), (__import__("datetime").date(2024, 1, 2), 1)]


def test_pivot_gives_null_without_rows_and_zero_without_matches(spark):
    rnd = random.Random(3)
    data = [(f"k{rnd.randrange(6)}", rnd.choice(["email", "sms", "whatsapp"]), rnd.choice(["sent", "open", None, "zzz"]))
            for _ in range(200)]
    data += [("only_email", "email", "zzz"), ("only_sms", "sms", "sent")]
    df = spark.createDataFrame(data, "g string, channel string, ev string")
    cols = [(f"{c}_{e}", c, e) for c in ("email", "whatsapp", "sms") for e in ("sent", "open")]
    want = []
    for g in {x[0] for x in data}:
        cell = []
        for _, c, e in cols:
            mine = [x[2] for x in data if x[0] == g and x[1] == c]
            cell.append(sum(x == e for x in mine) if mine else None)
        want.append((g, *cell))
    mine = channel_pivot(df, ["g"], "channel", "ev", cols)
    assert rows(mine, "g", *[c for c, _, _ in cols]) == sorted(want, key=repr)


def test_union_by_name_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("x", 1)], "s string, i int")
    out = union_channels(a, b, a)
    assert out.columns == ["i", "s"] and out.count() == 3


SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_lead_is_split_by_aqe_only_in_the_skew_safe_form(spark):
    """A lead holding a third of all logs: AQE splits it in the skew-safe J1
    (inner join), and cannot in a plain left join (hot key on the non-preserved side)."""
    leads = spark.range(2000).select(F.concat(F.lit("L"), F.col("id").cast("string")).alias("lid"))
    logs = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, F.lit("L7"))
        .otherwise(F.concat(F.lit("L"), (F.col("id") % 2000).cast("string"))).alias("leadId"),
        F.col("id").alias("log"), F.repeat(F.lit("x"), 40).alias("pad"))
    prev = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        split = {}
        for safe in (True, False):
            df = left_join_one_to_many(leads, logs, [("lid", "leadId")], {"log": "log", "pad": "pad"}, skew_safe=safe)
            assert len(df.collect()) == 60000          # runs the DataFrame's own adaptive plan
            split[safe] = "skew=true" in df._jdf.queryExecution().executedPlan().toString()
        assert split == {True: True, False: False}
    finally:
        for k, v in prev.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_fact_key_in_a_shuffled_lookup_is_split_by_aqe(spark):
    """A campaign with a third of all logs, looked up without broadcast: the fact
    side is the preserved side of the LEFT join, so AQE can split its hot partition."""
    facts = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, F.lit("c7")).otherwise(F.concat(F.lit("c"), (F.col("id") % 500).cast("string"))).alias("campaignId"),
        F.repeat(F.lit("x"), 40).alias("pad"))
    dim = spark.range(500).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("_id"), F.lit("n").alias("name"))
    prev = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        df = lookup(facts, dim, [("campaignId", "_id")], {"name": "campaignname"}, broadcast=False)
        assert len(df.collect()) == 60000
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in prev.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
