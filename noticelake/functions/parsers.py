"""Text to typed value: every parser is a pair of column expressions, the value and the error.

Null and blank texts give null without an error (CPV codes: null gives null, no code an empty array); texts that can't be read give null and a
message that starts with the parser's name. Parsers that never fail have a null error.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import durations, identifiers
from .text import blank, col, let, squeeze, strip


class Parsed(NamedTuple):
    value: Column
    error: Column


_NONE = lambda kind: F.lit(None).cast(kind)
# Currencies.
CURRENCIES = ("PLN", "EUR", "USD", "GBP", "CHF")
_NUM = r"\A([\d\s\x{a0},.]+?)\s*\x{a0}?\s*(?:PLN|EUR|USD|GBP|CHF)?\z"


def _found(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def _strict(name: str, raw: Column, value: Column) -> Parsed:
    read = F.when(~blank(raw), value)
    message = F.concat(F.lit(f"{name}: cannot read "), F.substring(raw, 1, 200))
    return Parsed(read, F.when(~blank(raw) & read.isNull(), message))


def _decimal(num: Column) -> Column:
    """A number with blanks and either separator as double; with both, dots separate thousands."""
    one = lambda n: F.replace(F.when(n.contains(".") & n.contains(","), F.replace(n, F.lit("."), F.lit(""))).otherwise(n), F.lit(","), F.lit("."))
    read = lambda n: F.when(n.rlike(r"\A(?:\d+\.?\d*|\.\d+)\z"), n.try_cast("double"))
    return let(let(F.regexp_replace(num, r"[ \x{a0}]", ""), one), read)


def pln_value(c: Column) -> Parsed:
    """Amount of money as double, its currency aside."""
    num = let(strip(c), lambda s: F.coalesce(_found(F.regexp_extract(s, _NUM, 1)), F.regexp_extract(s, r"\A([\d\s\x{a0},.]+)", 1)))
    return _strict("parse_pln_value", col(c), _decimal(strip(num)))


def tak_nie(c: Column) -> Parsed:
    s = F.lower(strip(c))
    return _strict("parse_tak_nie", col(c), F.when(s == "tak", True).when(s == "nie", False))


def criterion_weight(c: Column) -> Parsed:
    """Weight as int, halves to the even number."""
    num = F.regexp_extract(F.replace(strip(c), F.lit(" "), F.lit(" ")), r"([0-9][0-9\s.,]*)", 1)
    return _strict("parse_criterion_weight", col(c), F.bround(_decimal(strip(num))).try_cast("int"))


def cpv_codes(c: Column) -> Parsed:
    """All CPV codes in order, each once."""
    return Parsed(F.array_distinct(F.regexp_extract_all(col(c), F.lit(r"(?U)\b(\d{8}-\d)\b"), F.lit(1))), _NONE("string"))


def currency_code(c: Column) -> Parsed:
    return Parsed(_found(F.regexp_extract(col(c), rf"\b({'|'.join(CURRENCIES)})\b", 1)), _NONE("string"))


def int_from_text(c: Column) -> Parsed:
    return _strict("parse_int_from_text", col(c), F.regexp_extract(col(c), r"(\d+)", 1).try_cast("int"))


def date_from_text(c: Column) -> Parsed:
    return _strict("parse_date_from_text", col(c), _found(F.regexp_extract(col(c), r"(\d{4}-\d{2}-\d{2})", 1)))


def datetime_from_text(c: Column) -> Parsed:
    timed = r"(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2})"
    full = F.when(col(c).rlike(timed), F.concat(F.regexp_extract(col(c), timed, 1), F.lit("T"), F.regexp_extract(col(c), timed, 2)))
    return _strict("parse_datetime_from_text", col(c), F.coalesce(full, _found(F.regexp_extract(col(c), r"(\d{4}-\d{2}-\d{2})", 1))))


def list_from_newlines(c: Column) -> Parsed:
    """Lines that are not blank; null if there are none."""
    lines = F.filter(F.transform(F.split(col(c), r"\R"), strip), lambda x: x != "")
    return Parsed(F.when(F.size(lines) > 0, lines), _NONE("string"))


def nuts3_code(c: Column) -> Parsed:
    p = _strict("parse_nuts3_code", col(c), F.when(col(c).contains(" - "), strip(F.substring_index(col(c), " - ", 1))))
    return Parsed(_found(p.value), p.error)


def nuts3_name(c: Column) -> Parsed:
    p = _strict("parse_nuts3_name", col(c), F.when(col(c).contains(" - "), strip(F.regexp_extract(col(c), r"(?s)\A.*? - (.*)\z", 1))))
    return Parsed(_found(p.value), p.error)


_BEFORE, _AFTER = r"(?isu)Przed\s+zmian[aą]:", r"(?isu)Po\s+zmianie:"


def change_label(c: Column) -> Parsed:
    return Parsed(_found(strip(F.get(F.split(col(c), _BEFORE, 2), F.lit(0)))), _NONE("string"))


def change_before(c: Column) -> Parsed:
    rest = F.get(F.split(col(c), _BEFORE, 2), F.lit(1))
    return Parsed(_found(strip(F.get(F.split(rest, _AFTER, 2), F.lit(0)))), _NONE("string"))


def change_after(c: Column) -> Parsed:
    return Parsed(_found(strip(F.get(F.split(col(c), _AFTER, 2), F.lit(1)))), _NONE("string"))


def _misread(c: str, times: int) -> str:
    """A letter as it looks when its UTF-8 is read as the Central European code page, so many times, in lower case."""
    for _ in range(times):
        c = c.encode().decode("cp1250")
    return c.casefold()


#: Misread Polish letters and the plain letter each stands for, those misread twice first.
MISREAD = {_misread(c, times): plain for times in (2, 1) for c, plain in zip("ąćęłńóśźż", "acelnoszz", strict=True)}


def _plain_letters() -> tuple[dict[str, str], dict[str, str]]:
    """Characters that compatibility decomposition without its marks turns into one letter, and into several."""
    one, more = {}, {}
    for code in (*range(0xA0, 0x250), *range(0x1E00, 0x1F00), *range(0x2000, 0x2150), *range(0xFB00, 0xFB07), *range(0xFF00, 0xFF5F)):
        c = chr(code).casefold()
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if plain != chr(code):
            (one if len(plain) == 1 else more)[chr(code)] = plain
    return one, more


_ONE, _MORE = _plain_letters()


def normalized_label(c: Column | str) -> Column:
    """A label for matching: case folded, misread Polish letters mended, compatibility forms plain, marks out, single blanks. ``ł`` stays: its stroke is no mark."""
    lower = F.lower(col(c))
    for wrong, right in MISREAD.items():
        lower = F.replace(lower, F.lit(wrong), F.lit(right))

    def several(s: Column) -> Column:
        for a, b in _MORE.items():
            s = F.replace(s, F.lit(a), F.lit(b))
        return s

    rare = "[" + "".join(_MORE) + "]"
    plain = let(lower, lambda s: F.when(s.rlike(rare), several(s)).otherwise(s))
    return squeeze(F.regexp_replace(F.translate(plain, "".join(_ONE), "".join(_ONE.values())), r"\p{M}+", ""))


def _plain(value: Callable[[Column], Column]) -> Callable[[Column], Parsed]:
    return lambda c: Parsed(value(col(c)), _NONE("string"))


#: name -> (parser, Spark type), looked up by profiles; ``register`` adds to it.
REGISTRY: dict[str, tuple[Callable[[Column], Parsed], str]] = {
    "parse_pln_value": (pln_value, "double"),
    "parse_tak_nie": (tak_nie, "boolean"),
    "parse_criterion_weight": (criterion_weight, "int"),
    "parse_cpv_codes": (cpv_codes, "array<string>"),
    "parse_currency_code": (currency_code, "string"),
    "parse_int_from_text": (int_from_text, "int"),
    "parse_date_from_text": (date_from_text, "string"),
    "parse_datetime_from_text": (datetime_from_text, "string"),
    "parse_list_from_newlines": (list_from_newlines, "array<string>"),
    "parse_nuts3_code": (nuts3_code, "string"),
    "parse_nuts3_name": (nuts3_name, "string"),
    "parse_change_label": (change_label, "string"),
    "parse_change_before": (change_before, "string"),
    "parse_change_after": (change_after, "string"),
    "parse_national_id_value": (_plain(lambda c: identifiers.classify(c)["value"]), "string"),
    "parse_national_id_type": (_plain(lambda c: F.nullif(identifiers.classify(c)["type"], F.lit("not_recognized"))), "string"),
    "parse_duration_days_from_range": (_plain(durations.range_days), "int"),
    "parse_duration_start_date": (_plain(durations.start_date), "string"),
    "parse_duration_end_date": (_plain(durations.end_date), "string"),
    "parse_duration_iso": (_plain(durations.iso), "string"),
}

#: Parsers of one notice type, which come before those of all: (notice type, name) -> (parser, Spark type).
OVERRIDES: dict[tuple[str, str], tuple[Callable[[Column], Parsed], str]] = {}

#: Parsers of several columns.
COMPUTED: dict[str, tuple[Callable[..., Column], str]] = {"compute_duration_days": (durations.days, "int"), "compute_contract_end_date": (durations.contract_end, "string")}


def register(name: str, parser: Callable[[Column], Parsed], spark_type: str, notice_type: str | None = None) -> None:
    """Add or replace a parser, of one notice type if given; a Python or pandas UDF works too, wrapped to give (value, error)."""
    if notice_type is None:
        REGISTRY[name] = (parser, spark_type)
    else:
        OVERRIDES[notice_type, name] = (parser, spark_type)


def parser_of(name: str, notice_type: str | None = None) -> tuple[Callable[[Column], Parsed], str] | None:
    """The parser of a name, the notice type's own first; None if there is none."""
    return OVERRIDES.get((notice_type, name)) or REGISTRY.get(name)
