"""Contracts of section tables: which columns and types they have, how a table differs from them, and rows that break them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions.parsers import COMPUTED, parser_of
from noticelake.profiles import Profile


@dataclass(frozen=True)
class Drift:
    """How a table's columns differ from its contract: missing, extra, and of another type (column -> (wanted, found)). Ordinals and errors are never extra."""

    missing: tuple[str, ...] = ()
    extra: tuple[str, ...] = ()
    other_type: dict[str, tuple[str, str]] = field(default_factory=dict)

    def __bool__(self) -> bool:
        return bool(self.missing or self.other_type)


def contract(profile: Profile, entity: str, leaf: str) -> dict[str, str]:
    """Column -> Spark type of a section table, in the order it is written: parsed and plain sections, derived ones, computed ones."""
    sections = profile.models()[entity, leaf]
    kind = lambda name: (parser_of(name, profile.notice_type) or (None, "string"))[1] if name else "string"
    out = {s.column: kind(s.parser) for s in sections if not s.derived}
    out |= {name: kind(fn) for s in sections for name, fn in s.derived.items()}
    out |= {name: COMPUTED[f][1] for name, (f, sources) in profile.computed.items() if set(sources) <= set(out)}
    return out


def drift(df: DataFrame, wanted: Mapping[str, str], known: Sequence[str] = ("objectId", "publicationDateDay", "parse_errors")) -> Drift:
    """How ``df`` differs from a contract. Nothing is read."""
    have = dict(df.dtypes)
    extra = tuple(c for c in have if c not in wanted and c not in known and not c.endswith("_ordinal"))
    return Drift(tuple(c for c in wanted if c not in have), extra, {c: (k, have[c]) for c, k in wanted.items() if c in have and have[c] != k})


def violations(df: DataFrame, rules: Mapping[str, Column], key: str = "objectId", kind: str = "noticeType", data_model: str = "core") -> DataFrame:
    """(key, notice type, data_model, errors): rows that break a rule, ``column: message`` for each broken one.

    ``rules`` gives for each column an expression that is the message where its value breaks the rule, else null; values that are null break none. Types need no rule: the parsers'
    expressions guarantee them.
    """
    broken = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}: "), message)) for c, message in rules.items()])) if rules else F.array().cast("array<string>")
    return df.select(key, kind, F.lit(data_model).alias("data_model"), broken.alias("errors")).where(F.size("errors") > 0)


def between(column: str, least: float | None = None, most: float | None = None) -> Column:
    """A rule: the message where a number lies outside of its bounds."""
    v = F.col(column)
    bad = F.lit(False) if least is None else v < least
    bad = bad if most is None else bad | (v > most)
    return F.when(bad, F.concat(v.cast("string"), F.lit(f" is not within {'' if least is None else least}..{'' if most is None else most}")))


def matches(column: str, pattern: str) -> Column:
    """A rule: the message where a text does not match a pattern."""
    return F.when(~F.col(column).rlike(pattern), F.lit("unexpected form"))
