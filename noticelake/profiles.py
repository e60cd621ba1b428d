"""Profiles: which model and parsers each section of a notice type has."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field
from pathlib import Path


@dataclass(frozen=True)
class Section:
    """A numbered section: its model (``core``, ``<entity>``, ``<entity>.core`` or ``<entity>.<leaf>``), parser and derived columns (name -> parser)."""

    number: str
    model: str = "core"
    parser: str | None = None
    derived: dict[str, str] = field(default_factory=dict)
    full_block: bool = False

    @property
    def column(self) -> str:
        return "section_" + self.number.replace(".", "_")

    @property
    def entity(self) -> str:
        return self.model.split(".")[0]

    @property
    def leaf(self) -> str:
        """``core`` for the entity's own columns, else the repeated child."""
        return self.model.split(".")[1] if "." in self.model else "core"


@dataclass(frozen=True)
class Profile:
    """Sections of a notice type and columns computed from several of them (name -> (function, source columns))."""

    notice_type: str
    sections: tuple[Section, ...]
    computed: dict[str, tuple[str, tuple[str, ...]]] = field(default_factory=dict)

    def models(self) -> dict[tuple[str, str], list[Section]]:
        """Sections by (entity, leaf), in order."""
        out: dict[tuple[str, str], list[Section]] = {}
        for s in self.sections:
            out.setdefault((s.entity, s.leaf), []).append(s)
        return out


def table_name(notice_type: str | None, entity: str, leaf: str) -> str:
    """``contract_notice__part_criterion`` and the like; ``unknown__…`` without a type."""
    return f"{snake(notice_type or 'unknown')}__{entity}" + ("" if leaf == "core" else f"_{leaf}")


def snake(name: str) -> str:
    """``ContractNotice`` as ``contract_notice``."""
    return "".join("_" * (i > 0 and c.isupper()) + c.lower() for i, c in enumerate(name))


def load_profile(path: str | Path) -> Profile:
    """A profile kept as JSON: {notice_type, sections: [{number, model, parser, derived, full_block}], computed: {name: [function, [columns]]}}."""
    j = json.loads(Path(path).read_text())
    if "sections" not in j:
        raise ValueError(f"{path} has no sections; a file by section number is read with load_numbered_profile")
    sections = tuple(Section(s["number"], s.get("model", "core"), s.get("parser"), s.get("derived", {}), s.get("full_block", False)) for s in j["sections"])
    return Profile(j["notice_type"], sections, {k: (f, tuple(a)) for k, (f, a) in j.get("computed", {}).items()})


def load_numbered_profile(notice_type: str, path: str | Path) -> Profile:
    """A profile kept as JSON by section number: {number: {data_model, parser, derived_cols: {name: {fn}}, section_value_mode}, _computed_cols: [{col_name, fn, sources}]}.

    Entries that are no object or whose ``col_name`` isn't the number's own are refused, as their values would never reach their column.
    """
    j = json.loads(Path(path).read_text())
    sections = []
    for number, c in j.items():
        if number.startswith("_"):
            continue
        s = Section(number, c.get("data_model", "core"), c.get("parser"), {n: x["fn"] for n, x in c.get("derived_cols", {}).items()}, c.get("section_value_mode") == "full_block")
        if c.get("col_name", s.column) != s.column:
            raise ValueError(f"{path}: section {number} must be kept in {s.column}")
        sections.append(s)
    return Profile(notice_type, tuple(sections), {c["col_name"]: (c["fn"], tuple(c["sources"])) for c in j.get("_computed_cols", [])})


def find_profile(notice_type: str, folder: str | Path) -> Profile | None:
    """The profile of a type in a folder: ``<type>_profile.json``, else ``<type>_profile_automatic.json`` (the type in snake case), in either form; None if neither is there."""
    key = snake(notice_type)
    for path in (Path(folder) / f"{key}_profile.json", Path(folder) / f"{key}_profile_automatic.json"):
        if path.exists():
            return load_profile(path) if "sections" in json.loads(path.read_text()) else load_numbered_profile(notice_type, path)
    return None


def find_profiles(notice_types: Iterable[str], folder: str | Path) -> dict[str, Profile]:
    """The profiles of types that the folder has one of; for the others the built-in one, if any."""
    found = {t: find_profile(t, folder) or PROFILES.get(t) for t in notice_types}
    return {t: p for t, p in found.items() if p}


_ID = {"{}": "parse_national_id_value", "{}_type": "parse_national_id_type"}
_NUTS = {"{}_code": "parse_nuts3_code", "{}_name": "parse_nuts3_name"}
_MONEY = {"{}": "parse_pln_value", "{}_currency": "parse_currency_code"}
_CHANGE = {"{}_label": "parse_change_label", "{}_before": "parse_change_before", "{}_after": "parse_change_after"}


def _section(number: str, model: str = "core", parser: str | None = None, derived: dict[str, str] | None = None) -> Section:
    col = "section_" + number.replace(".", "_")
    return Section(number, model, parser, {k.format(col): v for k, v in (derived or {}).items()})


def _notice_update() -> Profile:
    core = [_section(n) for n in ("1.1", "1.4.2", "2.1", "3.1", "3.2", "3.3")]
    return Profile("NoticeUpdateNotice", (*core, _section("1.3", derived=_ID), _section("1.4.6", derived=_NUTS), _section("2.2", parser="parse_date_from_text"), _section("3.4", "part.core"), _section("3.4.1", "part.part", derived=_CHANGE)))


def _contract() -> Profile:
    part = [_section("4.2.2", "part.core"), _section("4.2.6", "part.core", "parse_cpv_codes"), _section("4.2.10", "part.core"), _section("4.3.1", "part.core")]
    text = [_section(n) for n in ("1.1", "1.4.2", "2.1", "2.2", "2.6", "3.1", "3.10", "3.15", "5.4", "5.7", "6.1", "6.4", "7.4", "8.2")]
    dated = [_section("2.5", parser="parse_date_from_text"), _section("4.1.2", parser="parse_int_from_text"), _section("8.1", parser="parse_datetime_from_text"), _section("8.3", parser="parse_datetime_from_text"), _section("8.4", parser="parse_date_from_text")]
    return Profile("ContractNotice", (*text, *dated, _section("1.3", derived=_ID), *part, _section("4.3.5", "part.criterion"), _section("4.3.6", "part.criterion", "parse_criterion_weight"), _section("9.1"), _section("9.2"), _section("9.3"), _section("9.4", parser="parse_date_from_text")))


def _tender_result() -> Profile:
    part = [_section("6.1", "part", "parse_int_from_text"), _section("6.2", "part", derived=_MONEY), _section("7.3.1", "part"), _section("8.2", "part", derived=_MONEY)]
    return Profile("TenderResultNotice", (_section("1.1"), _section("1.3", derived=_ID), _section("1.4.2"), _section("2.1"), _section("2.2"), *part, _section("9.1"), _section("9.2"), _section("9.3"), _section("9.4", parser="parse_date_from_text")))


#: Profiles that come with the library; others are loaded from JSON.
PROFILES = {p.notice_type: p for p in (_notice_update(), _contract(), _tender_result())}
