"""Code lists kept as trees."""

from __future__ import annotations

import json
from functools import lru_cache
from pathlib import Path


def flatten(items: list[dict]) -> dict[str, str]:
    """identifier -> key of all entries of a tree ({identifier, key, Items}) that have both; of equal identifiers the one met last, children after their parent."""
    out: dict[str, str] = {}
    left = list(reversed(items))
    while left:
        item = left.pop()
        if item.get("identifier") and item.get("key"):
            out[item["identifier"]] = item["key"]
        left += reversed(item.get("Items") or [])
    return out


@lru_cache
def load(path: str | Path) -> dict[str, str]:
    """The code list of a JSON file ({items: tree})."""
    return flatten(json.loads(Path(path).read_text(encoding="utf-8"))["items"])
