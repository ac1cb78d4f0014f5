"""Hourly archives over HTTP: addresses, fetching, what a response means.

``get`` is any callable (url) -> (status, bytes); nothing here needs a library.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from enum import Enum
from pathlib import Path

Get = Callable[[str], tuple[int, bytes]]


class Outcome(Enum):
    OK = "ok"
    ABSENT = "absent"
    EMPTY = "empty"
    FAILED = "failed"


@dataclass(frozen=True)
class Fetched:
    day: date
    hour: int
    outcome: Outcome
    path: str | None = None
    size: int = 0


def archive_url(base: str, day: date, hour: int) -> str:
    """The hour is not padded, the date is."""
    if not 0 <= hour <= 23:
        raise ValueError(f"no hour {hour}")
    return f"{base.rstrip('/')}/{day:%Y-%m-%d}-{hour}.json.gz"


def hours_between(first: datetime, last: datetime) -> Iterator[tuple[date, int]]:
    """Every hour from ``first`` to ``last``, both included."""
    at = first.replace(minute=0, second=0, microsecond=0)
    while at <= last:
        yield at.date(), at.hour
        at += timedelta(hours=1)


def outcome_of(status: int, size: int | None) -> Outcome:
    if status == 404:
        return Outcome.ABSENT
    if status != 200:
        return Outcome.FAILED
    return Outcome.OK if size else Outcome.EMPTY


def fetch_hour(get: Get, base: str, day: date, hour: int, dest: str, tries: int = 4, wait: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> Fetched:
    """Download one hour; a file appears under its name only when it is whole.
    Only failures that may pass (no answer, 429, 5xx) are tried again."""
    target = Path(dest) / f"{day:%Y-%m-%d}-{hour}.json.gz"
    for n in range(tries):
        try:
            status, body = get(archive_url(base, day, hour))
        except OSError:
            status, body = 0, b""
        result = outcome_of(status, len(body))
        if result is Outcome.OK:
            part = target.with_suffix(".part")
            part.parent.mkdir(parents=True, exist_ok=True)
            part.write_bytes(body)
            part.rename(target)
            return Fetched(day, hour, result, str(target), len(body))
        if result is not Outcome.FAILED or status not in (0, 429) and status < 500:
            return Fetched(day, hour, result)
        if n + 1 < tries:
            sleep(wait * 2**n)
    return Fetched(day, hour, Outcome.FAILED)


def fetch_hours(get: Get, base: str, hours: list[tuple[date, int]], dest: str, workers: int = 8, **options) -> list[Fetched]:
    """Several hours at once, results in the order asked for; one that fails does
    not stop the others."""

    def one(which: tuple[date, int]) -> Fetched:
        try:
            return fetch_hour(get, base, *which, dest, **options)
        except Exception:  # noqa: BLE001  reported as failed
            return Fetched(*which, Outcome.FAILED)

    with ThreadPoolExecutor(workers) as pool:
        return list(pool.map(one, hours))
