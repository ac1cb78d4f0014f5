"""Serving tables: the newest row of each key, published from feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.asof import rolling
from ..sources.snapshots import Contract, SnapshotStore

MODES = ("snapshot", "triggered", "continuous")


def latest_per_key(rows: DataFrame, key: list[str], time: str, tiebreak: list[str] | None = None) -> DataFrame:
    """The newest row of each key, by one aggregate (no sort); ties by ``tiebreak``,
    else by the other columns."""
    rest = [c for c in rows.columns if c not in key]
    order = F.struct(time, *(tiebreak or [c for c in rest if c != time]))
    row = F.max_by(F.struct(*rest), order)
    return rows.dropna(subset=[*key, time]).groupBy(*key).agg(row.alias("r")).select(*key, "r.*")


def repo_stream_features(events: DataFrame) -> DataFrame:
    return rolling(events, "repo_id").dropDuplicates(["repo_id", "event_time"]).drop("event_id")


def actor_stream_features(events: DataFrame) -> DataFrame:
    return rolling(events, "actor_login").dropDuplicates(["actor_login", "event_time"]).drop("event_id")


class OnlineStore:
    """Published tables under a folder, each a snapshot table with one row a key."""

    def __init__(self, store: SnapshotStore, created: bool = False) -> None:
        self.store, self._exists = store, created

    def create(self) -> OnlineStore:
        self._exists = True
        return self

    def require(self) -> OnlineStore:
        if not self._exists:
            raise LookupError("the online store does not exist; create it first")
        return self

    def delete(self) -> None:
        """Deleting twice is no error."""
        self._exists = False

    def publish(self, source: str, target: str, key: list[str], time: str, mode: str = "triggered") -> int:
        """Publish the newest rows of ``source``.  Modes other than ``snapshot``
        update incrementally and need a source whose versions record changes."""
        if mode not in MODES:
            raise ValueError(f"unknown mode {mode!r}")
        self.require()
        table = self.store.table(source)
        history = table.history()
        if not history:
            raise LookupError(f"{source} has no version")
        online = self.store.table(target)
        if mode == "snapshot" or online.version < 0:
            rows = latest_per_key(table.read(), key, time)
        else:
            done = online.history()[-1]["inputs"].get(source, -1)
            if any("added" not in e for e in history[done + 1 :]):
                raise ValueError(f"{source} does not record changes")
            rows = latest_per_key(online.read().unionByName(table.changes(done)), key, time)
        return online.write(rows, Contract.of(rows.schema, key), {source: len(history) - 1})
