"""Paged REST reads and a polite poller of an event feed.

``get`` is any callable (url, headers) -> Response.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime
from pathlib import Path


@dataclass(frozen=True)
class Response:
    status: int
    headers: dict[str, str] = field(default_factory=dict)
    body: object = None

    def header(self, name: str) -> str | None:
        return next((v for k, v in self.headers.items() if k.lower() == name.lower()), None)


Get = Callable[[str, dict[str, str]], Response]


class RequestFailed(RuntimeError):
    def __init__(self, response: Response, url: str) -> None:
        super().__init__(f"{response.status} from {url}")
        self.response = response


def exhausted(r: Response) -> bool:
    """Whether a refusal says that the allowance is used up."""
    return r.status in (403, 429) and (r.header("x-ratelimit-remaining") == "0" or r.header("retry-after") is not None)


def wait_for(r: Response, now: float, default: float = 60.0) -> float:
    """Seconds to wait: what ``retry-after`` says goes before the reset time."""
    if (after := r.header("retry-after")) is not None and after.isdigit():
        return float(after)
    if (reset := r.header("x-ratelimit-reset")) is not None and reset.isdigit():
        return max(0.0, float(reset) - now)
    return default


def next_page(link: str | None) -> str | None:
    """The address marked rel="next" in a Link header."""
    for part in (link or "").split(","):
        found = re.match(r"\s*<([^>]*)>(.*)", part)
        if found and re.search(r';\s*rel="?next"?\s*(;|$)', found[2]):
            return found[1]
    return None


@dataclass
class Client:
    get: Get
    token: str | None = None
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.time
    tries: int = 5

    def headers(self, **more: str) -> dict[str, str]:
        return ({"Authorization": f"Bearer {self.token}"} if self.token else {}) | more

    def ask(self, url: str, **more: str) -> Response:
        """One answer; waits while the allowance is used up, raises on other errors."""
        for _ in range(self.tries):
            r = self.get(url, self.headers(**more))
            if r.status in (200, 304):
                return r
            if not exhausted(r) and r.status != 429:
                break
            self.sleep(wait_for(r, self.clock()))
        raise RequestFailed(r, url)

    def pages(self, url: str) -> Iterator[object]:
        while url:
            r = self.ask(url)
            yield from r.body
            url = next_page(r.header("link"))


def pull_request(client: Client, base: str, owner: str, repo: str, number: int) -> dict:
    """What an enrichment keeps of one pull request."""
    body = client.ask(f"{base}/repos/{owner}/{repo}/pulls/{number}").body
    return {"owner": owner, "repo": repo} | {k: body.get(k) for k in ("number", "title", "body", "draft", "merged", "additions", "deletions", "changed_files")}


def pull_request_numbers(client: Client, base: str, owner: str, repo: str) -> Iterator[int]:
    for row in client.pages(f"{base}/repos/{owner}/{repo}/pulls?state=all&per_page=100"):
        yield row["number"]


@dataclass(frozen=True)
class Poll:
    events: list[dict]
    etag: str | None
    interval: float
    remaining: int | None
    unchanged: bool = False


def poll_once(client: Client, url: str, etag: str | None = None, pages: int = 3, interval: float = 60.0) -> Poll:
    """The feed's newest events, each id once, at most ``pages`` pages.  An answer
    of "not modified" has none.  The server may ask for a longer interval."""
    found: dict[str, dict] = {}
    new_tag = remaining = None
    for n in range(pages):
        r = client.ask(url, **({"If-None-Match": etag} if etag and not n else {}))
        if not n:
            asked = r.header("x-poll-interval")
            interval = max(interval, float(asked)) if asked else interval
            new_tag = r.header("etag") or etag
        left = r.header("x-ratelimit-remaining")
        remaining = int(left) if left and left.isdigit() else remaining
        if r.status == 304:
            return Poll([], new_tag, interval, remaining, True)
        for event in r.body:
            found.setdefault(str(event.get("id")), event)
        url = next_page(r.header("link"))
        if not url:
            break
    return Poll(list(found.values()), new_tag, interval, remaining)


def land_poll(events: list[dict], landing: str | Path, polled_at: datetime, number: int) -> Path:
    """One JSON-lines file of envelopes; it appears under its name when whole."""
    folder = Path(landing)
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"poll-{polled_at:%Y%m%dT%H%M%S}-{number:05d}.json"
    part = folder / f".{path.name}.part"
    part.write_text("".join(json.dumps({"polled_at": polled_at.isoformat(), "event": json.dumps(e)}) + "\n" for e in events))
    part.rename(path)
    return path


def run_poller(client: Client, url: str, landing: str, polls: int, **options) -> dict[str, int]:
    etag, stats = None, {"polls": 0, "events": 0, "files": 0, "unchanged": 0}
    for n in range(polls):
        poll = poll_once(client, url, etag, **options)
        etag = poll.etag
        stats["polls"] += 1
        stats["events"] += len(poll.events)
        stats["unchanged"] += poll.unchanged
        if poll.events:
            land_poll(poll.events, landing, datetime.fromtimestamp(client.clock(), UTC), n)
            stats["files"] += 1
        if n + 1 < polls:
            client.sleep(poll.interval)
    return stats


def capture(polls: list[list[str]], published: int | None = None) -> dict[str, float]:
    """Distinct ids over polls, mean overlap of a poll with the one before, and the
    share of what was published that they caught."""
    sets = [set(p) for p in polls]
    over = [len(a & b) / len(b) for a, b in zip(sets, sets[1:]) if b]
    seen = len(set().union(*sets)) if sets else 0
    return {"distinct": seen, "mean_overlap": sum(over) / len(over) if over else 0.0, "captured": seen / published if published else float("nan")}
