"""Canonical writing of the keys notices refer to each other by."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, strip

_NOTICE = r"(?U)(?<!\d)(\d{4})\s*/\s*BZP\s*(\d{8})(?!\d)"
_SECTION = r"(?U)\d+(?:\s*\.\s*\d+)+"


def notice_number(c: Column | str) -> Column:
    """``YYYY/BZP NNNNNNNN`` of a typed number (blanks, case, version and words around it ignored); null if there is none."""
    s = F.upper(col(c))
    return F.when(s.rlike(_NOTICE), F.concat(F.regexp_extract(s, _NOTICE, 1), F.lit("/BZP "), F.regexp_extract(s, _NOTICE, 2)))


def tender_id(c: Column | str) -> Column:
    """A tender id in lower case without blanks around it; blank gives null."""
    return F.nullif(F.lower(strip(c)), F.lit(""))


def loose_notice_key(c: Column | str) -> Column:
    """``notice_number``, or the stripped upper-case text where it has none: such a reference meets equal texts only."""
    return F.coalesce(notice_number(c), F.nullif(F.upper(strip(c)), F.lit("")))


def object_key(c: Column | str) -> Column:
    """An object id without blanks, braces, dashes and case; blank gives null."""
    return F.nullif(F.lower(F.regexp_replace(col(c), r"(?U)[\s{}\-]", "")), F.lit(""))


def leading_section_number(c: Column | str) -> Column:
    """The number a label starts with (``4.2.2. Krótki opis`` and ``3 Inne`` too); null if it doesn't."""
    return F.nullif(F.regexp_extract(strip(c), r"^\d+(?:\.\d+)*", 0), F.lit(""))


def notice_type_token(c: Column | str) -> Column:
    """A notice type as part of a file name: runs of other letters than A-Z, a-z, digits, ``_``, ``.`` and ``-`` as one ``_``, none at the ends."""
    token = F.trim(F.regexp_replace(col(c), r"[^A-Za-z0-9_.\-]+", "_"), F.lit("_"))
    return F.coalesce(F.when(token == "", "__EMPTY__").otherwise(token), F.lit("__NULL__"))


def file_name(c: Column | str) -> Column:
    """A text that is safe as a file's name."""
    return F.regexp_replace(col(c), r"[^A-Za-z0-9._\-]+", "_")


def snake_case(c: Column | str) -> Column:
    """``ContractNotice`` as ``contract_notice``."""
    return F.lower(F.regexp_replace(col(c), r"(?<!^)(?=[A-Z])", "_"))


def section_number(c: Column | str) -> Column:
    """First ``digits.digits…`` of a label without blanks; null if there is none."""
    return F.nullif(F.regexp_replace(F.regexp_extract(col(c), _SECTION, 0), r"(?U)\s", ""), F.lit(""))
