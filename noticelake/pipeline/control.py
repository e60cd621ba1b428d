"""Ranges, order, locks, resumable loops, timings and logs of runs."""

from __future__ import annotations

import json
import logging
import os
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

from noticelake.sources.manifests import is_done

#: Chain of the layers: each depends on the code of those before it.
LAYERS = ("fetch", "bronze", "silver", "deltas")


def chunks(items: Sequence, size: int) -> list[list]:
    """``items`` in pieces of ``size``; one piece for 0 and less, none for no items."""
    size = size if size > 0 else max(len(items), 1)
    return [list(items[i : i + size]) for i in range(0, len(items), size)]


def yesterday(today: date | None = None) -> str:
    return ((today or datetime.now(timezone.utc).date()) - timedelta(days=1)).isoformat()


def in_order(types: Sequence[str | None], priority: Mapping[str, int]) -> list[str | None]:
    """Notice types by priority (99 if none is given), then by name; the one without a type last."""
    return sorted(set(types), key=lambda t: (t is None, priority.get(t, 99), t or ""))


def dependency_hashes(hashes: Mapping[str, str], layer: str) -> dict[str, str]:
    """The code of the layers before ``layer``, which a manifest of it must have been written with."""
    return {x: hashes[x] for x in LAYERS[: LAYERS.index(layer)] if x in hashes}


def pending_types(root: str | Path, layer: str, days: Sequence[str], types: Sequence[str], hashes: Mapping[str, str]) -> dict[str, list[str]]:
    """type -> the days of a range on which it isn't done with this code; types that are done on all days are left out."""
    left = {t: [d for d in days if not is_done(root, layer, d, hashes[layer], dependency_hashes(hashes, layer), t)] for t in types}
    return {t: d for t, d in left.items() if d}


@contextmanager
def lock(path: str | Path, wait: float = 0.0, stale: float = 3600.0) -> Iterator[None]:
    """Hold a lock folder; TimeoutError if another holds it for longer than ``wait`` seconds. One older than ``stale`` seconds counts as left behind and is taken over."""
    p, until = Path(path), time.monotonic() + wait
    p.parent.mkdir(parents=True, exist_ok=True)
    while True:
        try:
            p.mkdir()
            break
        except FileExistsError:
            try:
                old = time.time() - p.stat().st_mtime > stale
            except FileNotFoundError:
                continue
            if old:
                try:  # only one of several that see it can move it away
                    p.rename(gone := p.with_name(f"{p.name}.{os.getpid()}.{time.monotonic_ns()}"))
                    gone.rmdir()
                except OSError:
                    pass
            elif time.monotonic() >= until:
                raise TimeoutError(f"{p} is held") from None
            else:
                time.sleep(0.05)
    try:
        yield
    finally:
        p.rmdir()


class DayLoop:
    """A loop over days that can be stopped and taken up again: the state of each day (pending, in_progress, completed, failed) and its attempts are kept in a file."""

    def __init__(self, path: str | Path, days: Sequence[str]) -> None:
        self.path = Path(path)
        if self.path.exists():
            self.state = json.loads(self.path.read_text())
            if list(self.state) != list(days):
                raise ValueError(f"{self.path} is about other days")
        else:
            self.state = {d: {"status": "pending", "attempts": 0} for d in days}
            self._keep()

    def _keep(self) -> None:
        self.path.parent.mkdir(parents=True, exist_ok=True)
        part = self.path.with_suffix(".part")
        part.write_text(json.dumps(self.state, indent=1))
        part.replace(self.path)

    def run(self, work: Callable[[str], object], most: int | None = None, go_on: bool = False) -> dict[str, str]:
        """Do ``work`` for the days that aren't completed, at most ``most`` of them; a failure is kept and raised, or with ``go_on`` the next day is done. The status of every day."""
        for d in [d for d, s in self.state.items() if s["status"] != "completed"][:most]:
            s = self.state[d]
            s.update(status="in_progress", attempts=s["attempts"] + 1)
            self._keep()
            try:
                work(d)
            except Exception as e:
                s.update(status="failed", error=str(e)[:500])
                self._keep()
                if not go_on:
                    raise
            else:
                s.pop("error", None)
                s.update(status="completed")
                self._keep()
        return {d: s["status"] for d, s in self.state.items()}


def run_stages(stages: Mapping[str, Callable[[], object]], clock: Callable[[], float] = time.monotonic) -> list[tuple[str, float, str]]:
    """(stage, seconds, status) of stages done one after the other, and a ``total``; after a failure the rest is ``skipped`` and the report is on the error as ``report``."""
    out, failed, begin = [], None, clock()
    for name, work in stages.items():
        if failed:
            out.append((name, 0.0, "skipped"))
            continue
        start = clock()
        try:
            work()
            out.append((name, clock() - start, "success"))
        except Exception as e:
            failed = e
            out.append((name, clock() - start, "failed"))
    out.append(("total", clock() - begin, "failed" if failed else "success"))
    if failed:
        failed.report = out
        raise failed
    return out


class JsonLines(logging.Formatter):
    """Log records as JSON lines: time, level, logger, message, the promoted fields where a record has them, and the exception."""

    # Fields of a record that stand at the top of its line.
    FIELDS = ("stage", "layer", "target_date", "notice_type", "run_id", "count", "seconds")

    def format(self, record: logging.LogRecord) -> str:
        line = {"time": datetime.fromtimestamp(record.created, timezone.utc).isoformat(), "level": record.levelname, "logger": record.name, "message": record.getMessage()}
        line |= {f: getattr(record, f) for f in self.FIELDS if hasattr(record, f)}
        if record.exc_info:
            line["exception"] = self.formatException(record.exc_info)
        return json.dumps(line, ensure_ascii=False, default=str)


def stage_logger(name: str, **fields: object) -> logging.LoggerAdapter:
    """A logger that gives its records these fields."""
    return logging.LoggerAdapter(logging.getLogger(name), fields, merge_extra=True)
