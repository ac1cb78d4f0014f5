"""Measurements before a long run: a day's throughput, what a dataset is like, how
fast texts encode, small samples for fixtures, and frames for a page."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from datetime import date, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.grounding import Verdict, check
from ..functions.text import bot_clause_column, renames_in
from ..operators.cleaning import duplicate_stats
from ..operators.learning import ranked
from ..operators.retrieval import Encoder
from ..sources.archive import Fetched, Outcome
from ..sources.snapshots import replace_partition
from ..sources.tables import read_archive
from .backfill import compare_engines, gb_per_hour


def calibrate_day(spark: SparkSession, day: date, fetch: Callable[[date], list[Fetched]], lake: str, ingested_at: datetime) -> dict:
    """One day to Bronze only; fetching and computing are timed apart."""
    began = time.monotonic()
    got = [f for f in fetch(day) if f.outcome is Outcome.OK]
    fetched = time.monotonic() - began
    if not got:
        raise LookupError(f"no archive of {day}")
    began = time.monotonic()
    replace_partition(read_archive(spark, [f.path for f in got], ingested_at).drop("event_date"), f"{lake}/bronze", event_date=day.isoformat())
    computed = time.monotonic() - began
    rows = spark.read.parquet(f"{lake}/bronze/event_date={day}").count()
    size = sum(f.size for f in got)
    return {"day": day.isoformat(), "hours": len(got), "rows": rows, "compressed_bytes": size, "fetch_seconds": fetched, "compute_seconds": computed, "fetch_gb_per_hour": gb_per_hour(size, fetched), "compute_gb_per_hour": gb_per_hour(size, computed), "rows_per_second": rows / computed if computed else None}


def dataset_profile(events: DataFrame, key: str = "event_id", name: str = "repo_name", entity: str = "repo_id") -> DataFrame:
    """measure, key, value: rows, distinct and redundant ids, events by type,
    accounts by the clause that makes them automated, and changes of names."""
    row = lambda measure, k, v: [F.lit(measure).alias("measure"), k.cast("string").alias("key"), v.cast("long").alias("value")]
    ids = duplicate_stats(events, key)
    out = ids.select(F.explode(F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).alias("v")) for c in ("total", "distinct", "duplicates")])).alias("x")).select(*row("ids", F.col("x.k"), F.col("x.v")))
    out = out.unionByName(events.groupBy("event_type").agg(F.count("*").alias("n")).select(*row("type", F.col("event_type"), F.col("n"))))
    accounts = events.where("actor_login is not null").select("actor_login").distinct().groupBy(bot_clause_column(F.col("actor_login")).alias("k")).agg(F.count("*").alias("n"))
    out = out.unionByName(accounts.select(*row("accounts", F.col("k"), F.col("n"))))
    if name in events.columns:
        moved = renames_in(events, entity, name).agg(F.count("*").alias("n"), F.countDistinct(entity).alias("e"))
        out = out.unionByName(moved.select(*row("renames", F.lit("changes"), F.col("n")))).unionByName(moved.select(*row("renames", F.lit("entities"), F.col("e"))))
    return out


def encode_rate(load: Callable[[], Encoder], texts: list[str], corpus: int, batch: int = 64, workers: int = 1) -> dict:
    """Texts a second of one encoder over a sample, and the hours that ``workers`` of
    them would take for ``corpus`` texts; loading is timed apart."""
    if not texts:
        raise ValueError("a probe needs texts")
    began = time.monotonic()
    encoder = load()
    loaded = time.monotonic() - began
    began = time.monotonic()
    for at in range(0, len(texts), batch):
        encoder(texts[at : at + batch])
    seconds = max(time.monotonic() - began, 1e-9)
    rate = len(texts) / seconds
    return {"texts": len(texts), "load_seconds": loaded, "seconds": seconds, "texts_per_second": rate, "projected_hours": corpus / (rate * workers) / 3600}


def sample_lines(source: str | Path, dest: str | Path, every: int, most: int = 2000) -> int:
    """Every n-th line of a file of JSON lines, the first included, as a fixture of at
    most ``most`` lines; lines that are no JSON objects are left out but counted."""
    if every < 1:
        raise ValueError("every needs to be 1 or more")
    kept = []
    with open(source) as lines:
        for k, line in enumerate(lines):
            if k % every or len(kept) >= most:
                continue
            try:
                if isinstance(json.loads(line), dict):
                    kept.append(line.rstrip("\n"))
            except json.JSONDecodeError:
                continue
    Path(dest).write_text("".join(f"{x}\n" for x in kept))
    return len(kept)


def paired_runs(layers: dict[str, Callable[[], object]], switch: Callable[[bool], None], pairs: int = 3, clock: Callable[[], float] = time.monotonic) -> dict[str, dict]:
    """Run every layer ``pairs`` times without and with an option and compare; the
    option is off again at the end, also after a failure."""
    runs: dict[bool, list[dict[str, float]]] = {False: [], True: []}
    try:
        for _ in range(pairs):
            for on in (False, True):
                switch(on)
                seconds = {}
                for name, layer in layers.items():
                    began = clock()
                    layer()
                    seconds[name] = clock() - began
                runs[on].append(seconds)
    finally:
        switch(False)
    return compare_engines(runs[False], runs[True])


# ---- frames for a page


def coverage_panel(features: DataFrame, columns: list[str]) -> DataFrame:
    """feature, non_null, null, pct_null (of all rows, one decimal), in one pass."""
    one = features.agg(F.count("*").alias("__n"), *[F.count(c).alias(c) for c in columns])
    rows = one.select("__n", F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("non_null")) for c in columns])).alias("x"))
    null = F.col("__n") - F.col("x.non_null")
    share = F.when(F.col("__n") > 0, F.round(null * 100.0 / F.col("__n"), 1)).otherwise(F.lit(0.0))
    return rows.select("x.feature", "x.non_null", null.alias("null"), share.alias("pct_null")).orderBy(F.desc("pct_null"), "feature")


def contribution_panel(values: dict[str, float], baseline: float) -> list[dict]:
    """The contributions of one row by size, then what they start from."""
    return [*ranked(values), {"feature": "baseline", "contribution": baseline, "direction": None}]


def grounding_panel(transcript: str | Path) -> Verdict:
    """The verdict on a recorded answer: JSON with ``answer`` and ``returns``."""
    found = json.loads(Path(transcript).read_text())
    return check(found["answer"], [(r["tool"], r["content"]) for r in found["returns"]])
