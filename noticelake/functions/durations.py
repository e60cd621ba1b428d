"""Contract durations: ranges of dates, end dates and counted days, weeks, months and years."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

# The stems that the words for days, weeks, months and years start with.
STEMS = {"D": ("dni", "dzień", "dzien"), "W": ("tyg",), "M": ("miesiąc", "miesiac", "miesię", "miesie"), "Y": ("lat", "rok")}

_DATE = r"(\d{4}-\d{2}-\d{2})"
_COUNTED = rf"(\d+)\s+({'|'.join(x for stems in STEMS.values() for x in stems)})"
#: Dates of a range, the end date alone, a number and its unit's stem: groups 1 and 2, 3, 4 and 5. What stands first in the text counts.
PATTERN = rf"(?iuU)od\s+{_DATE}\s+do\s+{_DATE}|do\s+{_DATE}|{_COUNTED}"
#: Counts beyond these end after the year 9999 whatever they start from.
_MOST = {"D": 3_700_000, "W": 530_000, "M": 120_000, "Y": 10_000}


def _group(c: Column | str, i: int) -> Column:
    return F.nullif(F.regexp_extract(col(c), PATTERN, i), F.lit(""))


def _unit(c: Column | str) -> Column:
    stem = F.lower(_group(c, 5))
    return F.coalesce(*[F.when(stem.isin(*stems), unit) for unit, stems in STEMS.items()])


def _day(text: Column) -> Column:
    return F.try_to_date(text, "yyyy-MM-dd")


def range_days(c: Column | str) -> Column:
    """Days between the two dates of a range; null for all else."""
    return F.datediff(_day(_group(c, 2)), _day(_group(c, 1)))


def start_date(c: Column | str) -> Column:
    return F.when(_group(c, 2).isNotNull(), _group(c, 1))


def end_date(c: Column | str) -> Column:
    return F.coalesce(_group(c, 2), _group(c, 3))


def iso(c: Column | str) -> Column:
    """``P12M`` and the like of a counted duration; null for dates."""
    return F.concat(F.lit("P"), F.regexp_replace(_group(c, 4), r"^0+(?=\d)", ""), _unit(c))


def _ends(start: Column | str, c: Column | str) -> Column:
    """The date a counted duration or end date gives, from ``start``; null if it lies after the year 9999."""
    s, unit, n = _day(col(start)), _unit(c), _group(c, 4).try_cast("int")
    of = lambda u: F.when((unit == u) & (n <= _MOST[u]), n)
    counted = F.coalesce(F.date_add(s, F.coalesce(of("D"), of("W") * 7)), F.add_months(s, F.coalesce(of("M"), of("Y") * 12)))
    return F.coalesce(F.when(F.year(counted) <= 9999, counted), F.when(s.isNotNull(), _day(_group(c, 3))))


def days(start: Column | str, c: Column | str) -> Column:
    """Duration in days; months and years by the calendar from ``start``. A range needs no start, all else is null without one."""
    return F.coalesce(range_days(c), F.when(_group(c, 2).isNull(), F.datediff(_ends(start, c), _day(col(start)))))


def contract_end(start: Column | str, c: Column | str) -> Column:
    """End date as ISO text, as ``days``; an end date is given back as written."""
    started = F.when(_day(col(start)).isNotNull(), F.coalesce(_group(c, 3), _ends(start, c).cast("string")))
    return F.coalesce(_group(c, 2), started)
