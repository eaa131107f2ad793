"""S5, S6, M7 support: full-refresh copy of tables to a relational database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.guards import complex_to_json
from .catalog import read_table


# connections open at once; a table of more partitions is coalesced for the write
DEFAULT_CONNECTIONS = 16


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    truncate: bool = False,
    num_partitions: int = DEFAULT_CONNECTIONS,
    batch_size: int | None = None,
) -> None:
    """Overwrite ``table`` with ``df``.  Complex columns become JSON text.

    Overwrite drops and recreates the target (or truncates it when
    ``truncate=True``, keeping its definition); each task writes its partition in
    its own transaction, so there is no transaction across partitions.
    ``num_partitions`` caps concurrent connections to the database (the writer's own
    option of that name would plan the table twice and spoil an observed row count).
    """
    props = dict(properties)
    if truncate:
        props["truncate"] = "true"
    if batch_size:
        props["batchsize"] = str(batch_size)
    complex_to_json(df).coalesce(num_partitions).write.jdbc(url=url, table=table, mode="overwrite", properties=props)


def sync_tables(
    spark: SparkSession,
    mapping: Mapping[str, str],
    url: str,
    properties: Mapping[str, str],
    truncate: bool = False,
    num_partitions: int = DEFAULT_CONNECTIONS,
) -> dict[str, int]:
    """Copy each source table to its target.  The row count is observed
    during the write itself (one pass per table, no separate ``count()`` job).
    Credentials come only from ``properties``."""
    counts: dict[str, int] = {}
    for source, target in mapping.items():
        obs = Observation(f"rows_{target}")
        df = read_table(spark, source).observe(obs, F.count(F.lit(1)).alias("rows"))
        write_jdbc(df, url, target, properties, truncate=truncate, num_partitions=num_partitions)
        counts[target] = int(obs.get["rows"])
    return counts
