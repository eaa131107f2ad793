"""Channel streams -> per-key counts pivoted by channel.

``channel_pivot`` is one ``groupBy`` of conditional sums: for each output column
(channel c, event e) it sums ``e matched ? 1 : 0`` over the rows of channel c
only.  A group with no row of channel c therefore gets NULL, a group with rows of
c but none matching e gets 0 - exactly what ``pivot(c, values).agg(sum(...))``
returns, in one shuffle instead of two, and only for the columns asked for.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PivotColumn = tuple[str, str, str]  # (output name, channel value, canonical event)


def union_channels(*frames: DataFrame) -> DataFrame:
    """Union by column name, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def channel_pivot(
    df: DataFrame,
    keys: Sequence[str],
    channel: str,
    event: str,
    columns: Sequence[PivotColumn],
) -> DataFrame:
    ch, ev = F.col(channel), F.col(event)
    return df.groupBy(*keys).agg(
        *[
            F.sum(F.when(ch == c, F.when(ev == e, F.lit(1)).otherwise(F.lit(0)))).alias(out)
            for out, c, e in columns
        ]
    )

