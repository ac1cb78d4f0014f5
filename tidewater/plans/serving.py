"""Point lookups for tools: features as of an instant, scores, explanations.

Every tool answers with a dictionary; what cannot be answered is refused with a
reason instead of a guess.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.learning import Registry, feature_set_version, ranked
from ..operators.retrieval import nearest_before
from ..sources.snapshots import SnapshotStore
from .features import assemble, pr_spine

FEATURES = ["prior_pr_count", "prior_merge_rate", "events_total_to_date", "bot_events_to_date", "prs_opened_to_date", "bot_share_to_date", "is_draft", "is_bot_author", "opened_day_of_week", "opened_hour"]


@dataclass(frozen=True)
class Request:
    repo_id: int
    pr_number: int
    as_of: datetime

    def __post_init__(self) -> None:
        if self.as_of.tzinfo is None:
            raise ValueError("as_of needs a time zone")


def refusal(reason: str, **more: object) -> dict:
    return {"refused": True, "reason": reason, **more}


class Tools:
    """``events`` are canonical events; feature tables come from ``store``, at
    pinned versions or the newest."""

    def __init__(self, spark: SparkSession, events: DataFrame, store: SnapshotStore, versions: dict[str, int] | None = None) -> None:
        self.spark, self.events, self.store = spark, events, store
        names = ["author_activity", "repo_activity", "pr_static"]
        pins = store.pins(versions, names)
        self.versions = {n: store.table(n).version if pins[n] is None else pins[n] for n in names}

    def _read(self, name: str) -> DataFrame:
        return self.store.table(name).read(self.versions[name])

    def get_features(self, request: Request) -> dict:
        """The features known strictly before ``as_of``."""
        mine = (F.col("repo_id") == request.repo_id) & (F.col("pr_number") == request.pr_number)
        spine = pr_spine(self.events.where(mine & (F.col("created_at") < F.lit(request.as_of)))).withColumn("as_of_timestamp", F.lit(request.as_of))
        author = self._read("author_activity")
        from ..operators.asof import as_of_join

        rows = as_of_join(spine, author, ["author_login"], "as_of_timestamp", "event_time")
        rows = as_of_join(rows, self._read("repo_activity").where(F.col("repo_id") == request.repo_id), ["repo_id"], "as_of_timestamp", "event_time")
        found = rows.join(self._read("pr_static").where(mine), ["repo_id", "pr_number"], "left").select(*FEATURES).collect()
        if not found:
            return refusal("not_open", detail="no such pull request was open then")
        return {"features": found[0].asDict(), "read_delta_versions": self.versions, "feature_set_version": feature_set_version(FEATURES)}

    def predict(self, request: Request, score: Callable[[dict], float], model_version: int) -> dict:
        fetched = self.get_features(request)
        if refused := self._refused(fetched):
            return refused
        risk = float(score(fetched["features"]))
        if not 0 <= risk <= 1:
            return refusal("score_out_of_range", value=risk)
        return {"breach_risk": risk, "model_version": model_version, "read_delta_versions": self.versions}

    def explain(self, request: Request, contributions: Callable[[dict], tuple[dict[str, float], float]], model_version: int) -> dict:
        fetched = self.get_features(request)
        if refused := self._refused(fetched):
            return refused
        values, baseline = contributions(fetched["features"])
        return {"contributions": ranked(values), "baseline": baseline, "model_version": model_version}

    def similar_prs(self, request: Request, k: int = 10, freshest: timedelta | None = None) -> dict:
        """The k nearest pull requests whose texts were known strictly before
        ``as_of``.  Refused without an embedding of this one, or if ``freshest`` is
        given and the newest embedding before ``as_of`` is older than that."""
        name = "embeddings"
        if self.store.table(name).version < 0:
            return refusal("no_embeddings")
        vectors = self.store.table(name).read(self.versions.get(name)).where(F.col("event_time") < F.lit(request.as_of))
        key = f"pr:{request.repo_id}:{request.pr_number}"
        own = vectors.where((F.col("entity_key") == key) & F.col("embedding").isNotNull()).orderBy(F.desc("event_time")).select("embedding").limit(1).collect()
        if not own:
            return refusal("not_embedded", entity_key=key)
        if freshest is not None:
            newest = vectors.agg(F.unix_micros(F.max("event_time")).alias("t")).first()["t"] / 1e6
            if request.as_of.timestamp() - newest > freshest.total_seconds():
                return refusal("stale_embeddings", newest=datetime.fromtimestamp(newest, UTC).isoformat())
        spine = self.spark.createDataFrame([(key, request.as_of, own[0]["embedding"])], "query_key string, as_of timestamp, embedding array<double>")
        found = nearest_before(spine, vectors.select("entity_key", "event_time", "embedding"), k).orderBy("rank").collect()  # k rows
        return {"neighbours": [{"entity_key": r["entity_key"], "distance": r["distance"], "rank": r["rank"]} for r in found]}

    @staticmethod
    def _refused(fetched: dict) -> dict | None:
        if fetched.get("refused"):
            return fetched
        missing = [k for k, v in fetched["features"].items() if v is None]
        return refusal("missing_features", missing=missing) if missing else None


def versions(registry: Registry, name: str) -> dict:
    """What the champion was trained on."""
    champion = registry.champion(name)
    return {"model_version": champion["version"], "training_data_delta_versions": champion["inputs"], "feature_set_version": champion["feature_set_version"]}


def parse_versions(tag: str) -> dict[str, int]:
    """Versions from a run's tag of data sources (JSON list of {name, version});
    cut-off text and conflicting versions are errors."""
    try:
        rows = json.loads(tag)
    except json.JSONDecodeError as error:
        raise ValueError("the tag is cut off") from error
    out: dict[str, int] = {}
    for r in rows:
        if out.setdefault(r["name"], int(r["version"])) != int(r["version"]):
            raise ValueError(f"two versions of {r['name']}")
    return out


class Gateway:
    """Calls of reviewed tools only, each recorded as a JSON line."""

    def __init__(self, tools: dict[str, Callable[..., dict]], reviewed: set[str], audit: str | Path) -> None:
        if unknown := sorted(reviewed - set(tools)):
            raise ValueError(f"reviewed but not there: {', '.join(unknown)}")
        self._tools, self.allowed, self._audit = tools, frozenset(reviewed), Path(audit)

    def call(self, name: str, **arguments) -> dict:
        began, outcome = time.monotonic(), "error"
        try:
            if name not in self.allowed:
                outcome = "denied"
                return refusal("not_allowed", tool=name)
            result = self._tools[name](**arguments)
            outcome = "refused" if result.get("refused") else "ok"
            return result
        finally:
            with self._audit.open("a") as f:
                f.write(json.dumps({"tool": name, "arguments": arguments, "outcome": outcome, "ms": round((time.monotonic() - began) * 1000, 3)}, default=str) + "\n")

    def records(self) -> list[dict]:
        return [json.loads(x) for x in self._audit.read_text().splitlines()] if self._audit.exists() else []
