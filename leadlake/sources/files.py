"""Bronze parquet scans."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, StringType, StructField, StructType


def read_bronze(
    spark: SparkSession, path: str, columns: Iterable[str] | Mapping[str, DataType] | None = None
) -> DataFrame:
    """Scan a parquet directory/file.  Column pruning and filter pushdown reach the
    scan through Catalyst, so callers just ``select``/``where`` what they need.

    Spark takes the schema of a folder from one of its files.  ``columns`` (names of text
    columns, or name -> type) are columns that a job reads where they are there: one that
    this file lacks is declared all the same, so what other files hold of it is not lost,
    and files without it give NULL (C4).  A column that no file has is NULL throughout.
    Only one footer is read, whatever the number of files.
    """
    df = spark.read.parquet(path)
    if columns is None:
        return df
    types = dict(columns) if isinstance(columns, Mapping) else {c: StringType() for c in columns}
    have = set(df.columns)
    missing = [StructField(c, t) for c, t in types.items() if c not in have]
    if not missing:
        return df
    return spark.read.schema(StructType([*df.schema.fields, *missing])).parquet(path)
