"""Text primitives used across the library."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters with marks and the plain letter each one folds to.
MARKED = "ąćęłńóśźżĄĆĘŁŃÓŚŹŻáàâäãåčďéèêëěíìîïľĺňñôöõòøřŕšťúùûüůýÿžçğışțţă"
PLAIN = "acelnoszzACELNOSZZaaaaaacdeeeeeiiiillnnooooorrstuuuuuyyzcgisttă".replace("ă", "a")

# Unicode blanks and control separators. Java tests a class of Latin-1 letters by one look-up, others one by one: hence two lists.
LATIN_BLANKS = r"\t-\r\x1c-\x20\x{85}\x{a0}"
WIDE_BLANKS = "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
BLANKS = LATIN_BLANKS + WIDE_BLANKS
#: The same blanks, letter by letter.
EVERY_BLANK = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0" + WIDE_BLANKS


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def strip(c: Column | str) -> Column:
    """Trim every Unicode blank (also NBSP and line ends) from both ends; null stays null."""
    return F.trim(col(c), F.lit(EVERY_BLANK))


def strip_end(c: Column | str) -> Column:
    """``strip`` of the right end alone."""
    return F.rtrim(col(c), F.lit(EVERY_BLANK))


def blank(c: Column | str) -> Column:
    """True for null, empty and all-blank values."""
    return ~F.coalesce(col(c).rlike(rf"[^{BLANKS}]"), F.lit(False))


def squeeze(c: Column | str) -> Column:
    """Strip, and write each run of Unicode blanks as one space."""
    first = LATIN_BLANKS.replace(r"\x1c-\x20", r"\x1c-\x1f")

    def plain(s: Column) -> Column:
        wide = F.lit(False)
        for b in WIDE_BLANKS:
            wide = wide | s.contains(b)
        return F.when(wide, F.translate(s, WIDE_BLANKS, " " * len(WIDE_BLANKS))).otherwise(s)

    return F.trim(F.regexp_replace(let(col(c), plain), rf"[{first}][{LATIN_BLANKS}]*| [{LATIN_BLANKS}]+", " "))


def fold(c: Column | str) -> Column:
    """Lower case without marks on Latin letters."""
    return F.translate(F.lower(col(c)), MARKED, PLAIN)


def section_key(c: Column | str) -> Column:
    """``4.2.10`` as ``[4, 2, 10]``; arrays of numbers compare number by number."""
    return F.transform(F.split(col(c), r"\."), lambda x: x.cast("int"))
