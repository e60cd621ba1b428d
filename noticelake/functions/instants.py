"""Instants as nanoseconds since 1970-01-01 UTC (bigint): exact for seven-digit fractions and free of the session's time zone.

Instants before 1684 or after 2255, which a bigint could not hold with room to reckon, count as the end they lie beyond.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, strip

SECOND = 1_000_000_000
#: Seconds from 1970 that instants are held within.
REACH = 9_000_000_000

_ISO = r"^(\d{4}-\d{2}-\d{2})[T ]([01]\d|2[0-3]):([0-5]\d)(?::([0-5]\d|60)(?:[.,](\d{1,9})\d*)?)?\s*(Z|z|[+-](?:0\d|1[0-8]):?[0-5]\d)?$"


def iso_nanos(c: Column | str) -> Column:
    """An ISO-8601 text with any offset and 0 to 9 fraction digits; no offset means UTC, a malformed text, date, time or offset gives null."""
    s = strip(c)
    g = lambda i: F.regexp_extract(s, _ISO, i)
    num = lambda x: F.coalesce(x.try_cast("bigint"), F.lit(0))
    zone = F.regexp_replace(g(6), ":", "")
    offset = F.when(zone.rlike(r"^[+-]\d{4}$"), (num(F.substring(zone, 2, 2)) * 3600 + num(F.substring(zone, 4, 2)) * 60) * F.when(zone.startswith("-"), -1).otherwise(1)).otherwise(0)
    days = F.datediff(F.try_to_date(F.nullif(g(1), F.lit(""))), F.lit("1970-01-01").cast("date"))
    seconds = days.cast("bigint") * 86400 + num(g(2)) * 3600 + num(g(3)) * 60 + num(g(4)) - offset
    return _held(seconds) * SECOND + num(F.rpad(F.when(g(5) == "", "0").otherwise(g(5)), 9, "0"))


def _held(seconds: Column) -> Column:
    return F.when(seconds.isNotNull(), F.least(F.greatest(seconds, F.lit(-REACH)), F.lit(REACH)))


def wall_nanos(c: Column | str) -> Column:
    """A zone-less timestamp column read as UTC."""
    t = col(c)
    whole = F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400 + F.hour(t) * 3600 + F.minute(t) * 60
    return _held(whole) * SECOND + (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("bigint") * 1000
