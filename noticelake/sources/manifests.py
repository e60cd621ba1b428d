"""Markers of what was processed by which code, so that a run can be repeated without doing it again."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterable
from datetime import datetime, timezone
from pathlib import Path


def code_hash(paths: Iterable[str | Path]) -> str:
    """SHA-256 over the Python files of the given files and folders, in order of name."""
    h = hashlib.sha256()
    for f in sorted({p for x in map(Path, paths) for p in ([x] if x.is_file() else x.rglob("*.py"))}):
        h.update(f.name.encode() + b"\0" + f.read_bytes())
    return h.hexdigest()


def _path(root: str | Path, layer: str, day: str, kind: str | None) -> Path:
    base = Path(root) / "_processed" / layer
    return base / day / f"{kind}.json" if kind else base / f"{day}.json"


def write(root: str | Path, layer: str, day: str, script_hash: str, dependencies: dict[str, str] | None = None, kind: str | None = None) -> None:
    """Write a marker, in one step."""
    p = _path(root, layer, day, kind)
    p.parent.mkdir(parents=True, exist_ok=True)
    part = p.with_suffix(f".{os.getpid()}.part")
    part.write_text(json.dumps({"layer": layer, "target_date": day, "notice_type": kind, "script_hash": script_hash, "dependency_hashes": dependencies or {}, "completed_at": datetime.now(timezone.utc).isoformat()}))
    part.replace(p)


def is_done(root: str | Path, layer: str, day: str, script_hash: str, dependencies: dict[str, str] | None = None, kind: str | None = None) -> bool:
    """True if the marker has this code and, where given, exactly these dependencies; a broken marker counts as none."""
    try:
        m = json.loads(_path(root, layer, day, kind).read_text())
    except (OSError, ValueError):
        return False
    return m.get("script_hash") == script_hash and (dependencies is None or m.get("dependency_hashes") == dependencies)
