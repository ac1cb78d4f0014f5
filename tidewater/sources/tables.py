"""Scans."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of a folder of Parquet tables.  Instants are UTC: timestamps
    without a zone become timestamps once, here."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    naive = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else df


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one in ``spark.checkpoint.dir``, which executors share;
    a temporary one only where that is unset and executors run on this machine."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tidewater-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def spark_path(path: str) -> str:
    """An address that Spark reads: URIs and cluster volumes as they are, local
    paths as absolute file URIs."""
    return path if "://" in path or path.startswith("/Volumes/") else Path(path).absolute().as_uri()


def read_archive(spark: SparkSession, paths: list[str], ingested_at) -> DataFrame:
    """raw_json, ingested_at, source_file, event_date, event_hour of hourly text
    files named ``yyyy-MM-dd-H.json.gz``: all files of a day in one scan, so that
    as many tasks read as there are files."""
    if ingested_at.tzinfo is None:
        raise ValueError("ingested_at needs a time zone")
    rows = spark.read.text([spark_path(p) for p in paths]).withColumnRenamed("value", "raw_json")
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    at = lambda group: F.regexp_extract(name, r"^(\d{4}-\d{2}-\d{2})-(\d{1,2})\.", group)
    return rows.select("raw_json", F.lit(ingested_at).alias("ingested_at"), name.alias("source_file"), at(1).alias("event_date"), at(2).try_cast("int").alias("event_hour"))


def freshness(rows: DataFrame, now, warn_hours: int = 6, error_hours: int = 24, column: str = "ingested_at") -> DataFrame:
    """One row: newest, age_seconds and state (pass, warn, error) of a source."""
    age = F.unix_timestamp(F.lit(now)) - F.unix_timestamp("newest")
    state = F.when(age.isNull() | (age > error_hours * 3600), "error").when(age > warn_hours * 3600, "warn").otherwise("pass")
    return rows.agg(F.max(column).alias("newest")).select("newest", age.alias("age_seconds"), state.alias("state"))
