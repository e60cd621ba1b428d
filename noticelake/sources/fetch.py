"""Fetching notices page by page through a caller's transport, and keeping them as raw days."""

from __future__ import annotations

import csv
import json
import random
import time
from collections.abc import Callable, Iterable, Iterator, Mapping
from pathlib import Path

# Answers after which a request is tried again, and notices of a page.
AGAIN = (429, 500, 502, 503, 504)
PAGE = 500


class HttpError(Exception):
    """An answer that is no success."""

    def __init__(self, status: int, text: str = "") -> None:
        super().__init__(f"{status} {text}".strip())
        self.status = status


def with_retries(call: Callable[[], object], tries: int = 5, first_wait: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> object:
    """``call()``, again after a lost connection, a timeout or an answer in AGAIN, after waits that double and vary by up to a second; other errors, and the last one, are raised."""
    for n in range(tries):
        try:
            return call()
        except HttpError as e:
            if e.status not in AGAIN or n == tries - 1:
                raise
        except (ConnectionError, TimeoutError):
            if n == tries - 1:
                raise
        sleep(first_wait * 2**n + random.random())
    raise ValueError("tries must be at least 1")


def pages(get: Callable[[Mapping[str, str]], list[dict]], notice_type: str, start: str, end: str, size: int = PAGE, **retry: object) -> Iterator[list[dict]]:
    """Pages of notices of a type and period: each is asked for after the last objectId of the one before, until one is empty or short or its last notice has no objectId."""
    query = {"NoticeType": notice_type, "PublicationDateFrom": start, "PublicationDateTo": end, "PageSize": str(size)}
    while True:
        page = with_retries(lambda: get(dict(query)), **retry)
        if page:
            yield page
        if len(page) < size or not page[-1].get("objectId"):
            return
        query["SearchAfter"] = page[-1]["objectId"]


def write_day(notices: Iterable[dict], root: str | Path, day: str) -> Path:
    """Keep a day's notices as one readable JSON array, in one step."""
    path = Path(root) / f"bzp_{day}.json"
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_suffix(".part")
    part.write_text(json.dumps(list(notices), ensure_ascii=False, indent=2), encoding="utf-8")
    part.replace(path)
    return path


def package_number(calendar: str | Path, day: str, date_column: str, number_column: str) -> str:
    """``YYYYNNNNN`` of the daily package that a release calendar (CSV) gives for a day (ISO); raises for a day without one."""
    with open(calendar, newline="", encoding="utf-8-sig") as f:
        for row in csv.DictReader(f):
            if row[date_column].strip() == day:
                return f"{int(day[:4])}{int(row[number_column]):05d}"
    raise LookupError(f"no package on {day}")
