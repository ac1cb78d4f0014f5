"""Small artifacts for a demonstration: layer counts, ranked queue, coverage."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import quarantine_by_rule
from .backfill import bronze_to_silver, queue_artifact


def medallion(eras: dict[str, DataFrame], path: str | Path) -> dict[str, dict]:
    """For each named Bronze frame: its rows, clean and quarantined rows, and the
    rules that fired; written as JSON."""
    out = {}
    for name, bronze in sorted(eras.items()):
        annotated = bronze_to_silver(bronze).persist()
        try:
            fired = {r["rule"]: r["rows_failed"] for r in quarantine_by_rule(annotated).collect()}  # a row a rule
            bad = fired.pop("ALL RULES (total quarantined)")
            total = annotated.count()
        finally:
            annotated.unpersist()
        out[name] = {"bronze": bronze.count(), "silver": total - bad, "quarantined": bad, "rules": fired}
    Path(path).write_text(json.dumps(out, indent=1, sort_keys=True))
    return out


def coverage(features: DataFrame, columns: list[str], path: str | Path) -> dict[str, float]:
    """The share of rows in which each feature is known; written as JSON."""
    one = features.agg(F.count("*").alias("__n"), *[F.count(c).alias(c) for c in columns]).first()
    shares = {c: one[c] / one["__n"] if one["__n"] else 0.0 for c in columns}
    Path(path).write_text(json.dumps(shares, indent=1, sort_keys=True))
    return shares


def load(spark: SparkSession, folder: str) -> tuple[dict, dict, DataFrame]:
    """medallion, coverage and queue of a folder of artifacts."""
    read = lambda name: json.loads(Path(folder, name).read_text())
    return read("medallion.json"), read("coverage.json"), spark.read.parquet(f"{folder}/queue")


__all__ = ["coverage", "load", "medallion", "queue_artifact"]
