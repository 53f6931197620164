"""Times as text to times in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc(text: Column) -> Column:
    """A time in UTC without a zone.  Text with an offset or ``Z`` is that instant, whatever the session's zone; text without one is taken as UTC; null if it is no time."""
    instant = F.convert_timezone(F.current_timezone(), F.lit("UTC"), text.try_cast("timestamp").cast("timestamp_ntz"))
    return F.when(text.rlike(r":\d\d[\d.]*\s*(?:[Zz]|[+-]\d\d?(?::?\d\d)?)\s*$"), instant).otherwise(text.try_cast("timestamp_ntz"))
