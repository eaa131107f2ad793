"""Full-refresh table replace and the JDBC copy.

JDBC runs against Derby's in-memory database inside the test JVM (no server, no
port); on a cluster only the driver would see such a database, so this is a
local test of the sink code, not a way to run the export.
"""

import pytest
from pyspark.sql import functions as F

from leadlake.plans.jobs import run_sync_to_rdbms
from leadlake.sources import read_table, replace_table, write_jdbc
from leadlake.sources.catalog import count_hot_keys, drop_table, known_hot_keys, table_versions


def test_replace_table_twice_and_read_back(spark):
    name = "silver_test.nation_copy"
    first = spark.createDataFrame([(1, ["a", "b"], ("x", 1))], "k int, arr array<string>, s struct<p:string,q:int>")
    replace_table(first, name)
    second = spark.createDataFrame([(2, ["c"], ("y", 2)), (3, None, None)], first.schema)
    replace_table(second, name)
    back = read_table(spark, name)
    assert back.schema == second.schema              # arrays and structs carried as they are
    assert sorted(r.k for r in back.collect()) == [2, 3]


def test_failing_v2_write_raises_and_leaves_the_old_table(spark):
    name = "silver_test.kept"
    replace_table(spark.range(3).toDF("k"), name)
    with pytest.raises(Exception, match="(?i)nosuchcatalog"):
        replace_table(spark.range(9).toDF("k"), f"nosuchcatalog.{name}")
    # a session catalog replaced by a v2 table format: no quiet fallback to a file table
    other = spark.newSession()
    other.conf.set("spark.sql.catalog.spark_catalog", "org.example.MissingCatalog")
    with pytest.raises(Exception, match="MissingCatalog"):
        replace_table(other.range(9).toDF("k"), name)
    with pytest.raises(ValueError):
        replace_table(other.range(9).toDF("k"), name, path="/elsewhere")
    assert read_table(spark, name).count() == 3


def test_failed_refresh_and_readers_of_the_old_version(spark):
    name = "silver_test.versions"
    assert replace_table(spark.range(5).toDF("k"), name) == {"rows": 5}
    began_before = read_table(spark, name)
    broken = spark.range(100, numPartitions=4).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("cut off")).cast("long")).otherwise(F.col("id")).alias("k"))
    with pytest.raises(Exception, match="cut off"):
        replace_table(broken, name)
    assert read_table(spark, name).count() == 5
    # another schema, partitions, buckets: the same single switch
    replace_table(spark.range(6).selectExpr("id AS k", "id % 2 AS p"), name, partition_by=["p"])
    assert sorted(map(tuple, read_table(spark, name).collect())) == [(k, k % 2) for k in range(6)]
    assert began_before.count() == 5                    # the version before stays until the next refresh
    replace_table(spark.range(7).toDF("z"), name, bucket_by=(2, ["z"]))
    assert read_table(spark, name).columns == ["z"]
    assert len(table_versions(spark, name)) == 2
    drop_table(spark, name)
    assert not spark.catalog.tableExists(name) and table_versions(spark, name) == []


def test_a_plain_table_becomes_versioned(spark):
    spark.sql("CREATE NAMESPACE IF NOT EXISTS silver_test")
    spark.range(3).write.saveAsTable("silver_test.plain")
    spark.range(3).write.saveAsTable("silver_test.plain__vault")     # somebody else's
    replace_table(spark.range(4), "silver_test.plain")
    replace_table(spark.range(4), "silver_test.plain")
    replace_table(spark.range(4), "silver_test.plain")
    assert read_table(spark, "silver_test.plain").count() == 4
    assert spark.catalog.tableExists("silver_test.plain__vault")
    drop_table(spark, "silver_test.plain")
    assert spark.catalog.tableExists("silver_test.plain__vault")
    drop_table(spark, "silver_test.plain__vault")


def test_observed_metrics_and_hot_keys_of_a_write(spark):
    name = "silver_test.hot"
    keys = ["a", "b"]
    odd = 'h"o\\t\'s'
    df = spark.range(1000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN CAST(id AS STRING) END AS a", "id % 2 AS b", "id AS k")
    df = df.withColumn("a", F.when(F.col("a") == "hot", F.lit(odd)).otherwise(F.col("a")))
    seen = replace_table(df, name, metrics={"most": F.max("k")}, hot_keys=keys)
    assert seen["rows"] == 1000 and seen["most"] == 999
    assert sorted(seen["hot_keys"]) == [(odd, 0), (odd, 1)]
    assert sorted(known_hot_keys(spark, name, keys)) == [(odd, 0), (odd, 1)]
    assert known_hot_keys(spark, name, ["a"]) is None
    assert sorted(count_hot_keys(read_table(spark, name), keys)) == [(odd, 0), (odd, 1)]
    replace_table(df, name)                             # not looked for: not known
    assert known_hot_keys(spark, name, keys) is None
    assert replace_table(df.limit(0), name, hot_keys=keys) == {"rows": 0, "hot_keys": []}


def test_jdbc_sync_counts_rows_and_serialises_complex_columns(spark):
    url = "jdbc:derby:memory:leadlake_test;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    src = spark.createDataFrame([(1, ["a"], ("x", 1)), (2, None, ("y", 2))], "k int, arr array<string>, s struct<p:string,q:int>")
    replace_table(src, "silver_test.to_export")
    counts = run_sync_to_rdbms(spark, {"silver_test.to_export": "EXPORTED"}, url, props)
    assert counts == {"EXPORTED": 2}
    back = spark.read.jdbc(url, "EXPORTED", properties=props)
    back = back.toDF(*[c.lower() for c in back.columns])
    got = {r["k"]: (r["arr"], r["s"]) for r in back.collect()}
    assert got == {1: ('["a"]', '{"p":"x","q":1}'), 2: (None, '{"p":"y","q":2}')}
    # full refresh: a second copy replaces the rows, it does not append
    write_jdbc(src.where(F.col("k") == 1), url, "EXPORTED", props, truncate=True)
    assert spark.read.jdbc(url, "EXPORTED", properties=props).count() == 1
