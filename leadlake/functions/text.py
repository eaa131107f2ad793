"""Text predicates and phone identity (F2, X2-X5, E1, phone_key)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digits(c: Column) -> Column:
    """Only the digits of ``c`` (NULL stays NULL)."""
    return F.regexp_replace(c.cast("string"), "[^0-9]", "")


def is_present(c: Column) -> Column:
    """not NULL, not blank once whitespace is removed, and not the text ``None``.

    Never NULL itself: a NULL input gives FALSE.
    """
    return c.isNotNull() & (F.regexp_replace(c, r"\s+", "") != "") & (c != "None")


def normalize_phone(raw: Column, cc: str = "91") -> Column:
    """The number as the lead dimension stores it (``normalized_whatsapp_number``).

    Rules, first match wins:
      NULL                                   -> NULL
      digits start with cc and raw is long   -> digits after cc
      raw starts with "+cc"                  -> raw after "+cc"
      raw starts with "+"                    -> raw after "+"
      otherwise                              -> raw unchanged
    "long" is measured on the raw text (so a dash counts).  A raw text that
    starts with cc also has digits that start with cc, so a separate
    "raw starts with cc" rule could never fire and is not written.  The rest of the
    text is kept to its end, however long.
    """
    clean = digits(raw)

    def after(c: Column, n: int) -> Column:
        return c.substr(F.lit(n + 1), F.length(c))

    return (
        F.when(raw.isNull(), F.lit(None).cast("string"))
        .when(clean.startswith(cc) & (F.length(raw) > 10), after(clean, len(cc)))
        .when(raw.startswith("+" + cc), after(raw, len(cc) + 1))
        .when(raw.startswith("+"), after(raw, 1))
        .otherwise(raw)
    )


def phone_key(raw: Column, cc: str = "91", national_len: int = 10) -> Column:
    """Join key for phone numbers (fixes the SMS / WhatsApp mismatch).

    Digits only; the country code is dropped when more than ``national_len``
    digits remain and they start with it; no digits at all -> NULL.
    """
    d = digits(raw)
    n = len(cc)
    return (
        F.when(d == "", F.lit(None).cast("string"))
        .when((F.length(d) > national_len) & d.startswith(cc), d.substr(F.lit(n + 1), F.length(d)))
        .otherwise(d)
    )
