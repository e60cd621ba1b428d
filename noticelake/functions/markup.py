"""HTML as text, with JVM expressions only."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, let, squeeze

# Named character references that notices use and the characters they stand for.
NAMED = {
    "nbsp": " ", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "oacute": "ó", "Oacute": "Ó", "aogon": "ą", "Aogon": "Ą", "eogon": "ę", "Eogon": "Ę",
    "cacute": "ć", "Cacute": "Ć", "lstrok": "ł", "Lstrok": "Ł", "nacute": "ń", "Nacute": "Ń", "sacute": "ś", "Sacute": "Ś", "zacute": "ź", "Zacute": "Ź",
    "zdot": "ż", "Zdot": "Ż", "ndash": "–", "mdash": "—", "bdquo": "„", "rdquo": "”", "ldquo": "“", "lsquo": "‘", "rsquo": "’", "hellip": "…", "sect": "§",
    "sup2": "²", "sup3": "³", "deg": "°", "euro": "€", "laquo": "«", "raquo": "»", "middot": "·", "times": "×", "shy": "­",
    "auml": "ä", "ouml": "ö", "uuml": "ü", "Auml": "Ä", "Ouml": "Ö", "Uuml": "Ü", "szlig": "ß", "eacute": "é", "amp": "&",
}


def _number(part: Column) -> Column:
    """What follows ``&#``: the character of the reference it starts with, or unchanged after ``&#``."""
    dec, hexa = F.regexp_extract(part, r"^(\d{1,7});", 1), F.regexp_extract(part, r"^[xX]([0-9a-fA-F]{1,6});", 1)
    code = F.coalesce(dec.try_cast("int"), F.conv(F.nullif(hexa, F.lit("")), 16, 10).try_cast("int"))
    good = code.isNotNull() & (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(F.when(good, code).otherwise(63).cast("bigint")), 8, "0")), "UTF-32")
    rest = F.regexp_replace(part, r"^[0-9a-zA-Z]{1,8};", "")
    return F.when(good, F.concat(char, rest)).otherwise(F.concat(F.lit("&#"), part))


def decode_entities(c: Column | str) -> Column:
    """Character references decoded once; unknown and broken ones stay as they are."""

    def numeric(s: Column) -> Column:
        joined = lambda parts: F.concat(F.element_at(parts, 1), F.array_join(F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), _number), ""))
        return F.when(s.contains("&#"), let(F.split(s, "&#"), joined)).otherwise(s)

    def replaced(s: Column, names: Iterable[str]) -> Column:
        for name in names:
            s = F.replace(s, F.lit(f"&{name};"), F.lit(NAMED[name]))
        return s

    common = ("nbsp", "oacute", "Oacute")
    rest = [n for n in NAMED if n not in common]
    return let(let(replaced(col(c), common), numeric), lambda s: F.when(s.contains("&"), replaced(s, rest)).otherwise(s))


def without_comments(c: Column | str, by: str = "") -> Column:
    """Markup without its comments; one that is never closed goes to the end."""
    s = col(c)
    return F.when(s.contains("<!--"), F.regexp_replace(s, r"(?s)<!--.*?(?:-->|\z)", by)).otherwise(s)


def markup_text(c: Column | str) -> Column:
    """Text of an HTML fragment: tags out, references decoded, single blanks. An unclosed tag at the end goes too."""
    return squeeze(decode_entities(F.regexp_replace(col(c), r"<[^>]*(?:>|\z)", " ")))


def closes_page(c: Column | str) -> Column:
    """True if the body contains a closing html tag outside of comments; null for null."""
    return without_comments(c).rlike(r"</[hH][tT][mM][lL]\s*>")
