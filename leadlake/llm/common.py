"""Shared helpers: input columns, words, intermediate tables, bitmaps, training split."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.session import scratch_dir

# White space of every word definition here: space, tab, LF, VT, FF, CR.
WORD_BREAK = r"[\x20\x09-\x0D]+"
NON_WORD_BREAK = r"[^\x20\x09-\x0D]"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of ``text``; NULL text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")


def held_out(doc_id: Column) -> Column:
    """True for the third of documents that no model may learn from (a NULL id
    counts as the text '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new Parquet table in the cluster's shared folder and read it back:
    later plans start from files, so a lost executor costs a re-read and not a
    recomputation, and nothing is computed twice."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that no plan reads any more: the rounds of a loop would
    else stay on disk until the session's folder goes."""
    for table in tables:
        spark = table.sparkSession
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs started within hand at most ``rows`` rows to a Python function at once: the
    session's 10,000 whole texts fill memory in the JVM and in Python.  A smaller setting of
    the session stays, and its setting is put back afterwards, also after a failure."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, min(rows, int(before)) if int(before) > 0 else rows)  # 0 or less: no limit
    try:
        yield
    finally:
        spark.conf.set(name, before)


BITMAP_BITS = 1 << 24


def bitmap_of(values: DataFrame, column: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """Bitmap of the longs in ``column``, by their value modulo ``bits``.  Its size is
    fixed (``bits`` / 8 bytes) whatever the number of values."""
    place = F.pmod(F.col(column), F.lit(bits)) + 1  # these functions count from 1
    parts = values.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    part_bytes = 1 << 12  # Spark's bitmaps hold 32,768 bits
    out = np.zeros(max(bits // 8, part_bytes), dtype=np.uint8)
    for r in parts:
        at = (r["bucket"] - 1) * part_bytes
        out[at:at + len(r["bits"])] = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
    return out


def bitmap_filter(values: DataFrame, column: str):
    """A filter ``f(column) -> bool`` that is true for every long in ``values`` and for
    few others.  With very many values it lets more through, so an exact join must
    follow."""
    shared = values.sparkSession.sparkContext.broadcast(bitmap_of(values, column))

    @F.pandas_udf("boolean")
    def holds(keys: pd.Series) -> pd.Series:
        at = keys.to_numpy(dtype=np.int64) % BITMAP_BITS
        return pd.Series((shared.value[at >> 3] >> (at & 7) & 1).astype(bool))

    return holds
