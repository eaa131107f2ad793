"""Spark result vs DuckDB oracle: column names, row count, order-insensitive values."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "as_integer_ratio") and not isinstance(v, int):  # Decimal
        return round(float(v), 6)
    return v


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    cols = spark_df.columns
    srows = [tuple(_norm(r[c]) for c in sorted(cols)) for r in spark_df.collect()]
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    if sorted(dcols) != sorted(cols):
        return False, f"columns differ: spark={sorted(cols)} duck={sorted(dcols)}"
    idx = [dcols.index(c) for c in sorted(cols)]
    drows = [tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()]
    if len(srows) != len(drows):
        return False, f"row count spark={len(srows)} duck={len(drows)}"
    cs, cd = Counter(srows), Counter(drows)
    if cs != cd:
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        return False, f"values differ; spark-only={only_s} duck-only={only_d} cols={sorted(cols)}"
    return True, f"{len(srows)} rows"
