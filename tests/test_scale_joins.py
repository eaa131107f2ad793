"""Joins of large sides: known hot keys, buckets, many roles with one shuffle; native inputs
and files that differ in their columns."""

import datetime as dt
import json
import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from leadlake.operators.guards import json_text, parse_or_null, safe_struct
from leadlake.operators.joins import left_join_one_to_many, left_join_salted, role_lookups, role_lookups_once
from leadlake.plans.lead_360 import LEAD_KEYS, LOG_KEYS, join_sides, lead_side, log_side
from leadlake.plans.catalogue import lead_360_inputs
from leadlake.sources import read_bronze, read_table, replace_table
from leadlake.sources.catalog import count_hot_keys

SF = "/root/testdata/sf0.001"
NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}


@pytest.fixture
def no_broadcast(spark):
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange (?:hash|range|round)\w+\(", plan(df)))


# -- J1 with hot keys


def sides(spark, seed):
    rnd = random.Random(seed)
    key = lambda: rnd.choice([None, "hot", "hot", "warm", *[f"k{n}" for n in range(12)]])
    leads = [(key(), rnd.choice(["o1", "o2", None]), n) for n in range(60)]
    logs = [(key(), rnd.choice(["o1", "o2", None]), f"g{n}") for n in range(400)]
    logs += logs[:50]                                   # repeated rows
    return (spark.createDataFrame(leads, "lid string, org string, n int"),
            spark.createDataFrame(logs, "leadId string, org string, log string"))


@pytest.mark.parametrize("seed", range(4))
def test_salted_join_equals_the_plain_left_join(spark, seed):
    leads, logs = sides(spark, seed)
    on, columns = [("lid", "leadId"), ("org", "org")], {"log": "log", "org": "org_log"}
    hot = count_hot_keys(logs, ["leadId", "org"])
    assert ("hot", "o1") in hot and all(None not in k for k in hot)
    plain = left_join_one_to_many(leads, logs, on, columns, skew_safe=False)
    salted = left_join_salted(leads, logs, on, columns, hot, salts=5)
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)
    assert rows(left_join_salted(leads, logs, on, columns, [])) == rows(plain)
    assert rows(left_join_salted(leads, logs.limit(0), on, columns, [])) == rows(
        left_join_one_to_many(leads, logs.limit(0), on, columns, skew_safe=False))


def test_salted_join_reads_each_side_once_and_spreads_the_hot_key(spark, no_broadcast, tmp_path):
    leads = spark.range(50).selectExpr("CAST(id AS STRING) AS lid")
    logs = spark.range(40_000).selectExpr(
        "CASE WHEN id % 3 > 0 THEN '7' ELSE CAST(id % 90 AS STRING) END AS leadId", "id AS log")
    leads.write.parquet(str(tmp_path / "leads"))
    logs.write.parquet(str(tmp_path / "logs"))
    leads, logs = spark.read.parquet(str(tmp_path / "leads")), spark.read.parquet(str(tmp_path / "logs"))
    hot = count_hot_keys(logs, ["leadId"])
    assert hot[0] == ("7",)
    joined = left_join_salted(leads, logs, [("lid", "leadId")], {"log": "log"}, hot[:1])
    text = plan(joined)
    assert text.count("FileScan") == 2 and exchanges(joined) == 2
    sizes = joined.withColumn("part", F.spark_partition_id()).groupBy("part").count().collect()
    assert max(r["count"] for r in sizes) < 0.5 * sum(r["count"] for r in sizes)   # two thirds have one key
    assert joined.count() == left_join_one_to_many(leads, logs, [("lid", "leadId")], {"log": "log"}).count()


def test_bucketed_tables_join_without_exchange(spark, no_broadcast):
    lf, lg, pr, lb = lead_360_inputs(spark, SF)
    replace_table(lf, "scale_test.leads", bucket_by=(4, LEAD_KEYS))
    replace_table(lg, "scale_test.logs", bucket_by=(4, LOG_KEYS), hot_keys=LOG_KEYS)
    leads, logs = read_table(spark, "scale_test.leads"), read_table(spark, "scale_test.logs")
    bare = left_join_one_to_many(
        leads.select(*LEAD_KEYS), logs.select("leadId", F.col("orgId").alias("o"), F.col("projectId").alias("p"), "payload_id"),
        [("_id", "leadId"), ("orgId", "o"), ("projectId", "p")], {"payload_id": "payload_id"}, skew_safe=False)
    assert exchanges(bare) == 0 and "SortMergeJoin" in plan(bare)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")      # lookups are small, the sides are not
    wide = join_sides(lead_side(leads, pr.hint("broadcast"), lb.hint("broadcast")).hint("merge"),
                      log_side(logs, lb.hint("broadcast")).hint("merge"), hot=[])
    assert exchanges(wide) == 0 and "SortMergeJoin" in plan(wide)
    again = join_sides(lead_side(lf, pr, lb), log_side(lg, lb))
    assert wide.count() == again.count()
    with pytest.raises(ValueError):
        other = spark.newSession()
        other.conf.set("spark.sql.catalog.spark_catalog", "org.example.MissingCatalog")
        replace_table(other.range(1), "scale_test.x", bucket_by=(2, ["id"]))


# -- J3 / J4 with one shuffle


def role_inputs(spark, seed):
    rnd = random.Random(seed)
    code = lambda: rnd.choice([None, "", "c1", "c2", "c3", "c9"])
    facts = [(n // 2, rnd.choice(["o1", "o2", None]), code(), code(), code(), "payload") for n in range(80)]
    labels = [(c, o, f"{c}-{o}", rnd.choice([None, "e"])) for c in ("", "c1", "c2", None) for o in ("o1", "o2", None)]
    labels += [("c2", "o1", "second of c2", "e2")]      # a key twice: rows multiply, as in the plain form
    return (spark.createDataFrame(facts, "k int, org string, status string, source string, prev string, pad string"),
            spark.createDataFrame(labels, "_id string, orgId string, label string, entity string"))


ROLES = {
    "status": ([("status", "_id"), ("org", "orgId")], {"label": "status_label", "entity": "entity"}),
    "source": ([("source", "_id"), ("org", "orgId")], {"label": "source_label"}),
}


@pytest.mark.parametrize("seed", range(3))
def test_roles_once_equal_roles_one_by_one(spark, seed):
    facts, labels = role_inputs(spark, seed)
    roles = {**ROLES, "prev": ([(F.lower("prev"), "_id"), ("org", "orgId")], {"label": "prev_label"})}
    once, plain = role_lookups_once(facts, labels, roles), role_lookups(facts, labels, roles)
    assert once.columns == plain.columns
    assert rows(once) == rows(plain)
    assert rows(role_lookups_once(facts, labels.limit(0), roles)) == rows(role_lookups(facts, labels.limit(0), roles))
    with pytest.raises(ValueError):
        role_lookups_once(facts, labels, {**roles, "x": ([("org", "orgId")], {"label": "x"})})


def test_roles_once_shuffle_the_wide_rows_once(spark, no_broadcast):
    facts, labels = role_inputs(spark, 1)
    roles = {k: ROLES[k] for k in ("status", "source")}

    def wide_shuffles(df):      # exchanges of rows that carry ``pad``
        found = 0
        stack = [df._jdf.queryExecution().executedPlan()]
        while stack:
            node = stack.pop()
            if "ShuffleExchange" in node.getClass().getSimpleName() and "pad#" in node.output().mkString(","):
                found += 1
            children = node.children()
            stack += [children.apply(n) for n in range(children.size())]
        return found
    assert wide_shuffles(role_lookups_once(facts, labels, roles)) == 1
    assert wide_shuffles(role_lookups(facts, labels, roles)) == 2


# -- native structs, VARIANT


DOC = StructType([
    StructField("name", StringType()), StructField("n", StringType()), StructField("flag", BooleanType()),
    StructField("count", IntegerType()), StructField("inner", StructType([
        StructField("x", StringType()), StructField("gone", StringType())])),
    StructField("tags", ArrayType(StringType())), StructField("items", ArrayType(StructType([StructField("id", StringType())]))),
    StructField("asText", StringType()), StructField("day", StringType()), StructField("absent", StringType()),
])


def documents(spark):
    schema = ("name string, n double, flag boolean, count int, inner struct<x:int,y:string>, tags array<string>, "
              "items array<struct<id:long,other:string>>, asText struct<q:int>, day date")
    data = [("a", 1.5, True, 3, (7, "y"), ["t", None], [(1, "o"), None], (9,), dt.date(2024, 1, 2)),
            ("", None, None, None, None, None, [], None, None), (None, 2.0, False, 0, (None, None), [], None, (None,), None)]
    return spark.createDataFrame([(k, d) for k, d in enumerate([*data, None])], f"k int, doc struct<{schema.replace(' ', ':').replace(',:', ',')}>")


def test_native_structs_are_projected_like_their_json(spark):
    docs = documents(spark)
    native = docs.select("k", safe_struct(docs, "doc", DOC).alias("s"))
    text = docs.select("k", F.to_json("doc").alias("doc"))
    parsed = text.select("k", safe_struct(text, "doc", DOC).alias("s"))
    assert native.schema["s"].dataType.simpleString() == parsed.schema["s"].dataType.simpleString()
    got = {r.k: r.s.asDict(True) if r.s else None for r in native.collect()}
    want = {r.k: r.s.asDict(True) if r.s else None for r in parsed.collect()}
    assert got == want
    simple = StructType([f for f in DOC.fields if f.name not in ("asText", "day")])
    tree = plan(docs.select(safe_struct(docs, "doc", simple).alias("s")))
    assert "to_json" not in tree and "from_json" not in tree
    assert [r.s for r in parse_or_null(docs, "doc", DOC).selectExpr("doc AS s").collect()] == [r.s for r in native.collect()]


def test_variants_are_read_by_path(spark):
    docs = documents(spark)
    text = docs.select("k", F.to_json("doc").alias("doc"))
    variant = text.select("k", F.parse_json("doc").alias("doc"))
    got = variant.select("k", safe_struct(variant, "doc", DOC).alias("s")).collect()
    want = {r.k: r.s for r in text.select("k", safe_struct(text, "doc", DOC).alias("s")).collect()}
    for r in got:
        a, b = r.s and r.s.asDict(True), want[r.k] and want[r.k].asDict(True)
        assert (a is None) == (b is None)
        if a:
            assert {k: v for k, v in a.items() if k not in ("n", "asText")} == {
                k: v for k, v in b.items() if k not in ("n", "asText")}
            assert (a["n"] and float(a["n"])) == (b["n"] and float(b["n"]))
            assert (a["asText"] and json.loads(a["asText"])) == (b["asText"] and json.loads(b["asText"]))
    assert json.loads(variant.select(json_text(variant, "doc")).first()[0])["name"] == "a"


# -- files that differ


def test_declared_columns_are_read_from_the_files_that_have_them(spark, tmp_path):
    folder = str(tmp_path / "bronze")
    spark.createDataFrame([(1, "old")], "k int, a string").coalesce(1).write.parquet(folder)
    spark.createDataFrame([(2, "x", 5)], "k int, b string, c int").coalesce(1).write.mode("append").parquet(folder)
    declared = read_bronze(spark, folder, {"a": StringType(), "b": StringType(), "c": IntegerType(), "d": StringType()})
    assert rows(declared, "k", "a", "b", "c", "d") == [(1, "old", None, None, None), (2, None, "x", 5, None)]
    by_name = read_bronze(spark, folder, ["a", "b"])
    assert rows(by_name, "k", "a", "b") == [(1, "old", None), (2, None, "x")]
    assert set(read_bronze(spark, folder).columns) < {"k", "a", "b", "c"}
    pushed = plan(declared.where("b = 'x'").select("k"))
    assert "PushedFilters: [IsNotNull(b), EqualTo(b,x)]" in pushed
