"""Days of archives through Bronze and Silver, resumable, with throughput."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import date, datetime, timedelta
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.payloads import normalize_events, parse_events
from ..operators.cleaning import EVENT_RULES, FAILED, apply_rules, deduplicate
from ..sources.archive import Fetched, Outcome
from ..sources.snapshots import read_partition, replace_partition
from ..sources.tables import read_archive


def gb_per_hour(size: int, seconds: float) -> float | None:
    return size / 1e9 / (seconds / 3600) if seconds > 0 else None


@dataclass
class Day:
    day: str
    hours: int = 0
    missing: list[int] = field(default_factory=list)
    compressed_bytes: int = 0
    clean: int = 0
    quarantined: int = 0
    seconds: dict[str, float] = field(default_factory=dict)

    def summary(self) -> dict:
        return asdict(self) | {"gb_per_hour": {k: gb_per_hour(self.compressed_bytes, v) for k, v in self.seconds.items()}}


def bronze_to_silver(bronze: DataFrame, rules=EVENT_RULES) -> DataFrame:
    """Parsed, normalised, deduplicated and annotated: one frame, one plan."""
    return apply_rules(deduplicate(normalize_events(parse_events(bronze))), rules)


def write_silver(annotated: DataFrame, root: str, event_date: str) -> tuple[int, int]:
    """Write the annotated day once; clean and quarantined rows are its two
    partitions, and both counts come from one pass over what was written."""
    flagged = annotated.withColumn("quarantined", F.size(FAILED) > 0)
    replace_partition(flagged.drop("event_date"), f"{root}/events", event_date=event_date)
    one = flagged.sparkSession.read.parquet(f"{root}/events/event_date={event_date}").agg(F.count_if(~F.col("quarantined")).alias("ok"), F.count_if("quarantined").alias("bad")).first()
    return one["ok"], one["bad"]


def read_clean(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/events").where("not quarantined").drop("quarantined", FAILED)


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/events").where("quarantined").drop("quarantined")


def process_day(spark: SparkSession, day: date, fetched: list[Fetched], lake: str, ingested_at: datetime) -> Day:
    """Land a day's files in Bronze (one scan) and bring it to Silver."""
    got = [f for f in fetched if f.outcome is Outcome.OK]
    out = Day(day.isoformat(), len(got), [f.hour for f in fetched if f.outcome is not Outcome.OK], sum(f.size for f in got))
    began = time.monotonic()
    if got:
        rows = read_archive(spark, [f.path for f in got], ingested_at)
        replace_partition(rows.drop("event_date"), f"{lake}/bronze", event_date=out.day)
    out.seconds["bronze"] = time.monotonic() - began
    began = time.monotonic()
    if got:
        bronze = read_partition(spark, f"{lake}/bronze", event_date=out.day).withColumn("event_date", F.col("event_date").cast("string"))
        out.clean, out.quarantined = write_silver(bronze_to_silver(bronze), lake, out.day)
    out.seconds["silver"] = time.monotonic() - began
    return out


class Markers:
    """One JSON file for each day that is done."""

    def __init__(self, folder: str | Path) -> None:
        self.folder = Path(folder)

    def done(self) -> set[date]:
        found = set()
        for p in self.folder.glob("*.json"):
            try:
                found.add(date.fromisoformat(p.stem))
            except ValueError:
                continue
        return found

    def record(self, day: date, stats: dict) -> None:
        self.folder.mkdir(parents=True, exist_ok=True)
        part = self.folder / f"{day}.part"
        part.write_text(json.dumps(stats, indent=1))
        part.rename(self.folder / f"{day}.json")


def pending_days(first: date, last: date, done: set[date]) -> list[date]:
    days = [first + timedelta(days=k) for k in range((last - first).days + 1)]
    return [d for d in days if d not in done]


def backfill(spark: SparkSession, first: date, last: date, fetch: Callable[[date], list[Fetched]], lake: str, markers: Markers, ingested_at: datetime) -> list[Day]:
    """All days not done yet, in order.  A day is marked once it is written, and a
    rerun of an unmarked day replaces it."""
    out = []
    for day in pending_days(first, last, markers.done()):
        result = process_day(spark, day, fetch(day), lake, ingested_at)
        markers.record(day, result.summary())
        out.append(result)
    return out


def compare_engines(off: list[dict[str, float]], on: list[dict[str, float]]) -> dict[str, dict]:
    """Seconds by layer of paired runs without and with an option: speed-ups, their
    mean, and a verdict only if all pairs agree by more than 5 %."""
    out = {}
    for layer in off[0] if off else ():
        ups = [a[layer] / b[layer] for a, b in zip(off, on) if b.get(layer)]
        mean = sum(ups) / len(ups) if ups else None
        verdict = "helped" if ups and min(ups) > 1.05 and max(ups) / min(ups) < 1.5 else "hurt" if ups and max(ups) < 0.95 else "indeterminate"
        out[layer] = {"speedups": ups, "mean": mean, "verdict": verdict}
    return out


def queue_artifact(predictions: DataFrame, path: str, top: int = 200) -> None:
    """The ranked queue as one Parquet file; its rows are bounded by ``top``."""
    from pyspark.sql import Window

    best = predictions.orderBy(F.desc("breach_risk"), "repo_id", "pr_number").limit(top)
    ranked_rows = best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("breach_risk"), "repo_id", "pr_number")))
    ranked_rows.coalesce(1).write.mode("overwrite").parquet(path)
