"""Catalog tables and the full-refresh sink."""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """S2."""
    return spark.read.table(name)


def _namespace_of(name: str) -> str | None:
    parts = name.split(".")
    return ".".join(parts[:-1]) if len(parts) > 1 else None


def ensure_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    """S4.  ``location`` is the folder of the tables of a new namespace."""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}{at}")


SESSION_CATALOG = "spark_catalog"


def _is_file_catalog(spark: SparkSession, name: str) -> bool:
    """True for the built-in session catalog, whose file tables know no atomic replace.
    A deployment may put a v2 table format in its place (``spark.sql.catalog.spark_catalog``)."""
    parts = name.split(".")
    catalog = parts[0] if len(parts) > 2 else spark.catalog.currentCatalog()
    return catalog == SESSION_CATALOG and not spark.conf.get(f"spark.sql.catalog.{SESSION_CATALOG}", None)


NOTE = "leadlake: "      # begins the comment of a view, the rest is JSON
KEPT_VERSIONS = 1


def replace_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] | None = None,
    path: str | None = None,
    bucket_by: tuple[int, Sequence[str]] | None = None,
    metrics: Mapping[str, Column] | None = None,
    hot_keys: Sequence[str] | None = None,
) -> dict[str, Any]:
    """S3: create or replace ``name`` with ``df`` (full refresh), creating its namespace
    first.  Returns what was observed while it was written: ``rows`` and ``metrics`` (name ->
    aggregate), so nothing is counted in a run of its own (A8).  ``hot_keys`` names key columns
    whose very frequent values are looked for on the way (``hot_key_summary``); a version of a
    file table remembers them.

    On a v2 catalog (also one that replaces the session catalog) this is
    ``writeTo(name).createOrReplace()``: an atomic swap where the catalog stages its tables
    (as table formats do); any error is raised.

    The built-in session catalog has no such statement for file tables.  There every refresh
    writes a table of its own, ``<name>__v<time>_<id>``, and ``name`` is a view of the newest
    complete one: one change in the metastore moves all readers, whatever became of schema,
    partitions or buckets.  A write that fails leaves the view as it was.  Queries that began
    before go on reading their version: the one before the current is kept until the next
    refresh, older ones are dropped.  A plain table of that name, from before there were
    versions, is dropped between the write and the first view.

    ``path`` puts the versions of such a table into folders below it (external tables: their
    files stay when a version is dropped).  ``bucket_by`` (number, columns) buckets and sorts
    them, one file a bucket, so that joins on these columns need no exchange.  Both are for
    the built-in catalog only.
    """
    spark = df.sparkSession
    ns = _namespace_of(name)
    seen = Observation(f"write_{uuid.uuid4().hex}")
    wanted = {**(metrics or {}), **({"hot_keys": hot_key_summary(hot_keys)} if hot_keys else {})}
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in wanted.items()])

    def found() -> dict[str, Any]:
        out = dict(seen.get)
        if hot_keys:
            out["hot_keys"] = frequent_keys(out["hot_keys"], out["rows"], hot_keys)
        return out

    if not _is_file_catalog(spark, name):
        if path or bucket_by:
            raise ValueError("path and bucket_by are for file tables of the built-in session catalog only")
        if ns:
            ensure_namespace(spark, ns)
        writer = observed.writeTo(name)
        if partition_by:
            writer = writer.partitionedBy(*[F.col(c) for c in partition_by])
        writer.createOrReplace()
        return found()
    if ns:
        ensure_namespace(spark, ns)
    version = f"{name}__v{time.time_ns()}_{uuid.uuid4().hex[:8]}"
    if bucket_by:
        observed = observed.repartition(bucket_by[0], *bucket_by[1])
    w = observed.write.format("parquet")
    if path:
        w = w.option("path", f"{path.rstrip('/')}/{version.rpartition('.')[2]}")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        w = w.bucketBy(bucket_by[0], *bucket_by[1]).sortBy(*bucket_by[1])
    w.saveAsTable(version)
    told = found()
    _switch(spark, name, {
        "version": version, **({"hot_keys": {"columns": list(hot_keys), "keys": told["hot_keys"]}} if hot_keys else {})})
    _drop_old_versions(spark, name)
    return told


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.getTable(name).tableType == "VIEW"


def _switch(spark: SparkSession, name: str, note: Mapping[str, Any]) -> None:
    if spark.catalog.tableExists(name) and not _is_view(spark, name):
        spark.sql(f"DROP TABLE {name}")
    comment = (NOTE + json.dumps(note)).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE OR REPLACE VIEW {name} COMMENT '{comment}' AS SELECT * FROM {note['version']}")


def _note(spark: SparkSession, name: str) -> dict[str, Any]:
    """What the view of a versioned table tells: its version, and hot keys if looked for."""
    text = spark.catalog.getTable(name).description or ""
    return json.loads(text.removeprefix(NOTE)) if text.startswith(NOTE) else {}


def table_versions(spark: SparkSession, name: str) -> list[str]:
    """The complete versions of a file table, oldest first."""
    ns, _, table = name.rpartition(".")
    names = [t.name for t in spark.catalog.listTables(ns or None, f"{table}__v*")]
    own = re.compile(re.escape(table) + r"__v\d+_[0-9a-f]{8}", re.IGNORECASE)
    return [f"{ns}.{n}" if ns else n for n in sorted(names) if own.fullmatch(n)]


def _drop_old_versions(spark: SparkSession, name: str, keep: int = KEPT_VERSIONS) -> None:
    current = _note(spark, name)["version"].lower()
    older = [v for v in table_versions(spark, name) if v.lower() < current]
    for version in older[:len(older) - keep] if keep else older:
        spark.sql(f"DROP TABLE IF EXISTS {version}")


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop ``name``, with all versions of a file table."""
    if spark.catalog.tableExists(name) and _is_view(spark, name):
        spark.sql(f"DROP VIEW {name}")
        for version in table_versions(spark, name):
            spark.sql(f"DROP TABLE IF EXISTS {version}")
        return
    spark.sql(f"DROP TABLE IF EXISTS {name}")


# -- keys that hold a large share of the rows

HOT_SHARE = 0.01            # of all rows; so there are at most 100 such keys
TRACKED_KEYS = 10_000       # size of the summary that finds them


def hot_key_summary(keys: Sequence[str]) -> Column:
    """Aggregate of bounded size: the most frequent values of ``keys`` (as JSON text) with
    their counts, about; merged across tasks.  Rows with a NULL key do not count."""
    whole = [F.col(k).isNotNull() for k in keys]
    text = F.when(reduce(lambda a, b: a & b, whole), F.to_json(F.struct(*keys)))
    return F.call_function("approx_top_k", text, F.lit(round(1 / HOT_SHARE)), F.lit(TRACKED_KEYS))


def frequent_keys(summary: Sequence[Any] | None, rows: int, keys: Sequence[str]) -> list[tuple]:
    """The keys of a summary that hold ``HOT_SHARE`` of the rows or more.  A summary holds
    only keys that are there, so a join may rely on each having a row."""
    out = []
    for item, count in summary or []:
        if item is not None and count >= max(HOT_SHARE * rows, 2):
            values = json.loads(item)
            out.append(tuple(values[k] for k in keys))
    return out


def known_hot_keys(spark: SparkSession, name: str, keys: Sequence[str]) -> list[tuple] | None:
    """The frequent values of ``keys`` found when the current version of ``name`` was written;
    None if they were not looked for.  Versions do not change, so they are still there."""
    if not _is_file_catalog(spark, name) or not spark.catalog.tableExists(name) or not _is_view(spark, name):
        return None
    told = _note(spark, name).get("hot_keys")
    if not told or told["columns"] != list(keys):
        return None
    return [tuple(k) for k in told["keys"]]


def count_hot_keys(df: DataFrame, keys: Sequence[str]) -> list[tuple]:
    """The frequent values of ``keys`` by a run over these columns, for tables that do not
    remember them."""
    seen = Observation(f"hot_{uuid.uuid4().hex}")
    narrow = df.select(*keys).observe(seen, F.count(F.lit(1)).alias("rows"), hot_key_summary(keys).alias("summary"))
    narrow.write.format("noop").mode("overwrite").save()
    return frequent_keys(seen.get["summary"], seen.get["rows"], keys)
