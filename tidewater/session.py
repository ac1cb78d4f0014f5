"""Sessions: UTC, adaptive execution, shuffles sized to where they run."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _base(app: str) -> SparkSession.Builder:
    return (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )


def local(cores: int | str = "*", partitions: int = 8, app: str = "tidewater") -> SparkSession:
    """A session on this machine, without UI."""
    return (
        _base(app)
        .master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def active(app: str = "tidewater") -> SparkSession:
    """The session in use, or one configured by the launcher, or a local one."""
    return SparkSession.getActiveSession() or local(app=app)


def warehouse(path: str, app: str = "tidewater", catalog: str = "in-memory") -> SparkSession:
    """A local session whose managed tables live under ``path``."""
    return _base(app).config("spark.sql.warehouse.dir", path).config("spark.sql.catalogImplementation", catalog).master("local[*]").getOrCreate()
