"""Cutting an ordered series into spans.

A window over a whole series runs in one task. Where a series has no natural bound,
the operators window within ``(key, span)`` and carry one summary row per span over
to the next, which is exact for "last value", "previous row" and "product".
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def date_span(on: Column | str, days: int) -> Column:
    """Number of the ``days``-long span a date falls into."""
    return F.floor(F.unix_date(on) / F.lit(days)).cast("int")


def position(ordinal: Column | str, data_type: T.DataType) -> Column | None:
    """An integer that never falls as ``ordinal`` rises; None for types without one."""
    ordinal = F.col(ordinal) if isinstance(ordinal, str) else ordinal
    if isinstance(data_type, T.IntegralType):
        return ordinal.cast("long")
    if isinstance(data_type, T.DateType):
        return F.unix_date(ordinal).cast("long")
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(ordinal)
    if isinstance(data_type, T.TimestampNTZType):
        # Wall-clock seconds: going through an instant would not keep the order at
        # a daylight-saving change.
        clock = F.hour(ordinal) * 3600 + F.minute(ordinal) * 60 + F.second(ordinal)
        return F.unix_date(ordinal.cast("date")).cast("long") * 86_400 + clock
    return None
