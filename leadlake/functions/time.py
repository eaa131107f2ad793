"""Event time -> local wall time, independent of the session zone.

Results are TIMESTAMP_NTZ wall-clock values in ``tz``; ``F.to_date`` of them is the
local day.  Inputs of every kind are shifted exactly once:

* TIMESTAMP_NTZ and zone-less text are read as wall time in ``assume_zone`` (UTC);
* date-only text is midnight in ``assume_zone``;
* TIMESTAMP (an instant) and text with a time and an offset or ``Z`` are instants;
* epoch milliseconds are instants; a fraction of a millisecond is cut off.
Unparseable text gives NULL (``try_cast``), never an error under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

LOCAL_TZ = "Asia/Kolkata"
# an offset can only follow a time: in 2024-01-01 the last "-01" is the day
_ZONED_TEXT = r"[T ][0-9]{1,2}(:[0-9.:]*)?\s*(Z|[+-][0-9]{1,2}(:?[0-9]{2})?)$"


def local_event_time(
    c: Column,
    dtype: DataType,
    tz: str = LOCAL_TZ,
    assume_zone: str = "UTC",
) -> Column:
    if isinstance(dtype, TimestampNTZType):
        return F.convert_timezone(F.lit(assume_zone), F.lit(tz), c)
    if isinstance(dtype, TimestampType):
        # two-argument form: the implicit instant -> wall-clock cast and the
        # source zone are both the session zone, so the pair cancels out
        return F.convert_timezone(None, F.lit(tz), c)
    if isinstance(dtype, DateType):
        return F.convert_timezone(F.lit(assume_zone), F.lit(tz), c.cast("timestamp_ntz"))
    if isinstance(dtype, StringType):
        text = F.trim(c)
        return F.when(
            text.rlike(_ZONED_TEXT),
            F.convert_timezone(None, F.lit(tz), text.try_cast("timestamp")),
        ).otherwise(
            F.convert_timezone(F.lit(assume_zone), F.lit(tz), text.try_cast("timestamp_ntz"))
        )
    raise TypeError(f"cannot read event time from {dtype.simpleString()}")


def local_event_time_from_epoch_ms(ms: Column, tz: str = LOCAL_TZ) -> Column:
    """Epoch milliseconds (number or numeric text, decimals too) -> local wall time."""
    whole = ms.try_cast("decimal(38,6)").try_cast("bigint")
    return F.convert_timezone(None, F.lit(tz), F.timestamp_millis(whole))

