"""Distinct-lead engagement funnels.

Collapsed form (used by the jobs): one aggregate to one row per campaign key and
lead (first event time and max of every flag), one aggregate to counts per
campaign key and first-event day.  Because min-of-min is min and max-of-max is
max, the reference's per-event dedup step (A1) is subsumed, and because there is
exactly one row per campaign key and lead after the first aggregate, the distinct
count of leads with a flag equals ``count_if(flag = 1)``: two shuffles, both with
map-side partial aggregation, and no ``Expand``.

``first_event_dedup`` is the per-event rule on its own, for callers that want one row
per lead and event; no job needs it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lead_flags(
    events: DataFrame,
    group_keys: Sequence[str],
    lead: str,
    ts: str,
    flags: Mapping[str, Column],
) -> DataFrame:
    """A1+A2+A7: one row per ``group_keys`` x ``lead``: first event time, its day,
    and ``max`` of every flag expression (evaluated per event row)."""
    first = F.min(ts)
    return events.groupBy(*group_keys, lead).agg(
        first.alias("first_event_ts"),
        F.to_date(first).alias("event_date"),
        *[F.max(expr).alias(name) for name, expr in flags.items()],
    )


def funnel_counts(
    flags_df: DataFrame,
    group_keys: Sequence[str],
    counts: Mapping[str, Column],
    total_name: str = "total_unique_leads",
) -> DataFrame:
    """A3/A4 over the output of ``lead_flags``: per ``group_keys`` x ``event_date``,
    the number of leads, and for each named condition the number of leads meeting it."""
    return flags_df.groupBy(*group_keys, "event_date").agg(
        F.count(F.lit(1)).alias(total_name),
        *[F.count_if(F.coalesce(cond, F.lit(False))).alias(name) for name, cond in counts.items()],
    )


def first_event_dedup(
    events: DataFrame,
    group_keys: Sequence[str],
    lead: str,
    event: str,
    ts: str,
    attrs: Sequence[str],
) -> DataFrame:
    """One row per lead x group keys x event; first time and max of attributes."""
    return events.groupBy(lead, *group_keys, event).agg(
        F.min(ts).alias("first_event_ts"), *[F.max(a).alias(a) for a in attrs]
    )

