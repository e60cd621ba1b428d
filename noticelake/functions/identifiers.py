"""Polish national identifiers: check digits and classification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank, col, fold, squeeze, strip

# Weights of the check sums.
NIP_WEIGHTS = (6, 5, 7, 2, 3, 4, 5, 6, 7)
REGON9_WEIGHTS = (8, 9, 2, 3, 4, 5, 6, 7)
REGON14_WEIGHTS = (2, 3, 4, 5, 6, 7, 8, 9, 2, 3, 4, 5, 6)
PESEL_WEIGHTS = (1, 3, 7, 9, 1, 3, 7, 9, 1, 3)


def _digit(c: Column, i: int) -> Column:
    return F.substring(c, i, 1).try_cast("int")


def _sum(c: Column, weights: Sequence[int]) -> Column:
    total = F.lit(0)
    for i, w in enumerate(weights, 1):
        total = total + _digit(c, i) * w
    return total


def _checked(c: Column | str, weights: Sequence[int], expected: Column) -> Column:
    n = len(weights) + 1
    return F.coalesce(F.when(col(c).rlike(rf"^\d{{{n}}}$"), _digit(col(c), n) == expected), F.lit(False))


def is_nip(c: Column | str) -> Column:
    return _checked(c, NIP_WEIGHTS, F.nullif(_sum(col(c), NIP_WEIGHTS) % 11, F.lit(10)))


def is_regon9(c: Column | str) -> Column:
    return _checked(c, REGON9_WEIGHTS, _sum(col(c), REGON9_WEIGHTS) % 11 % 10)


def is_regon14(c: Column | str) -> Column:
    return _checked(c, REGON14_WEIGHTS, _sum(col(c), REGON14_WEIGHTS) % 11 % 10)


def is_pesel(c: Column | str) -> Column:
    """Check digit and a date that exists; the month carries the century."""
    s = col(c)
    month = F.substring(s, 3, 2).try_cast("int")
    century = F.element_at(F.array(*map(F.lit, (1900, 2000, 2100, 2200, 1800))), F.floor(month / 20).cast("int") + 1)
    born = F.try_to_date(F.format_string("%04d-%02d-%s", century + F.substring(s, 1, 2).try_cast("int"), month % 20, F.substring(s, 5, 2)))
    return _checked(s, PESEL_WEIGHTS, (10 - _sum(s, PESEL_WEIGHTS) % 10) % 10) & F.coalesce(F.when(month.between(0, 99), born.isNotNull()), F.lit(False))


#: A NIP as written: its groups of digits with at most one blank or dash between neighbours, and no digit before or after.
_WRITTEN_NIP = r"(?<!\d)" + r"[-\s]?".join(rf"\d{{{n}}}" for n in (3, 3, 2, 2)) + r"(?!\d)"


def classify(c: Column | str) -> Column:
    """struct(value, type) of a typed identifier: NIP, REGON or PESEL, the first of each kind that checks, in that order.

    Eight digits are a REGON without its leading zero. An 11-digit run is a PESEL even if it doesn't check; null gives a null struct.
    """
    raw = col(c)
    digits = F.regexp_replace(raw, r"\D", "")
    all_of = lambda rule: F.regexp_extract_all(raw, F.lit(rule), F.lit(0))
    first = lambda xs, ok: F.get(F.filter(F.transform(xs, lambda x: F.regexp_replace(x, r"\D", "")), ok), F.lit(0))
    nip = F.coalesce(first(all_of(_WRITTEN_NIP), is_nip), F.lit(None))
    padded = lambda x: F.when(F.length(x) == 8, F.lpad(x, 9, "0")).otherwise(x)
    is_regon = lambda x: is_regon14(x) | is_regon9(x)
    regon = F.get(F.filter(F.transform(all_of(r"(?<!\d)(?:\d{14}|\d{9}|\d{8})(?!\d)"), padded), is_regon), F.lit(0))
    runs = all_of(r"(?<!\d)\d{11}(?!\d)")
    pesel = F.coalesce(F.get(F.filter(runs, is_pesel), F.lit(0)), F.get(runs, F.lit(0)))
    last = padded(digits)
    hit = lambda value, kind: F.struct(value.alias("value"), F.lit(kind).alias("type"))
    return (
        F.when(raw.isNull(), F.lit(None))
        .when(nip.isNotNull(), hit(nip, "NIP"))
        .when(regon.isNotNull(), hit(regon, "REGON"))
        .when(pesel.isNotNull(), hit(pesel, "PESEL"))
        .when(is_nip(digits), hit(digits, "NIP"))
        .when(is_regon(last), hit(last, "REGON"))
        .when(F.length(digits) == 11, hit(digits, "PESEL"))
        .otherwise(hit(F.lit(None).cast("string"), "not_recognized"))
    )


def is_poland(country: Column | str) -> Column:
    n = squeeze(fold(country))
    return F.coalesce(n.contains("polska") | n.contains("poland") | (F.regexp_replace(n, "[^a-z]", "") == "pl"), F.lit(False))


def by_country(country: Column | str, raw: Column | str) -> Column:
    """struct(raw, parsed, type): classified for Poland, as it stands and ``foreign`` elsewhere; null for a blank identifier."""
    s = strip(raw)
    k = classify(s)
    return F.when(~blank(raw), F.when(is_poland(country), F.struct(s.alias("raw"), k["value"].alias("parsed"), k["type"].alias("type"))).otherwise(F.struct(s.alias("raw"), s.alias("parsed"), F.lit("foreign").alias("type"))))


def with_classified_ids(contractors: Column | str) -> Column:
    """Contractors with contractorNationalId replaced by its raw, parsed and type; null and empty lists stay."""

    def one(c: Column) -> Column:
        k = by_country(c["contractorCountry"], c["contractorNationalId"])
        return c.dropFields("contractorNationalId").withField("contractorNationalId_raw", k["raw"]).withField("contractorNationalId_parsed", k["parsed"]).withField("contractorNationalId_type", k["type"])

    return F.transform(col(contractors), one)
