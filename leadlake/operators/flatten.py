"""Nested fields -> flat, named columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flatten(struct_col: str, prefix: str, fields: Iterable[str]) -> list[Column]:
    """``struct_col.f`` -> ``prefix_f`` for every ``f`` in ``fields``."""
    return [F.col(f"{struct_col}.{f}").alias(f"{prefix}_{f}") for f in fields]


def project_paths(df: DataFrame, spec: Sequence[tuple[str, str]]) -> DataFrame:
    """P1/P2/P8 driven by data: ``spec`` is a list of (output name, dotted path).
    Paths can be any depth; complex values are carried unchanged."""
    return df.select(*[F.col(path).alias(name) for name, path in spec])
