"""Live events: the batch transforms over a file stream, landed exactly once.

There is no watermark.  A late event is kept and flagged; a redelivered one is
dropped because its id is in the table already.  Only the days that a batch
touches are read from the table.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions.payloads import CANONICAL, normalize_events, parse_events
from ..functions.text import is_late

LANDING = "polled_at string, event string"


class StreamRejected(RuntimeError):
    """A batch holds an event that cannot be identified."""


def to_silver(envelopes: DataFrame, late_after_seconds: int) -> DataFrame:
    """Canonical events with ``is_late`` from landing envelopes (polled_at, event).
    Day and hour are those of the event."""
    raw = envelopes.select(
        F.col("event").alias("raw_json"),
        F.try_to_timestamp("polled_at").alias("ingested_at"),
        F.lit(None).cast("string").alias("event_date"),
        F.lit(None).cast("int").alias("event_hour"),
    )
    rows = normalize_events(parse_events(raw))
    at = F.col("created_at")
    rows = rows.withColumns({"event_date": F.date_format(at, "yyyy-MM-dd"), "event_hour": F.hour(at)}).select(*CANONICAL)
    return rows.withColumn("is_late", is_late(at, F.col("ingested_at"), late_after_seconds))


def stream_events(spark: SparkSession, landing: str, late_after_seconds: int = 600, metrics: str = "ingest", max_files: int | None = None) -> DataFrame:
    """A stream over JSON-lines files, with counts observed on each batch."""
    reader = spark.readStream.schema(LANDING)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    silver = to_silver(reader.json(landing), late_after_seconds)
    return silver.observe(
        metrics,
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.coalesce("is_late", F.lit(False))).alias("late_count"),
        F.count_if(F.coalesce(F.col("schema_era") != "reduced_v3", F.lit(True))).alias("non_reduced_count"),
    )


class MetricsListener(StreamingQueryListener):
    """Sums of observed counts over all batches of all queries."""

    def __init__(self, name: str = "ingest") -> None:
        self.name, self.totals, self.batches = name, {}, 0

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            self.batches += 1
            for k, v in row.asDict().items():
                self.totals[k] = self.totals.get(k, 0) + (v or 0)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def observed(query: StreamingQuery, name: str = "ingest") -> dict[str, int]:
    """Sums of observed counts over the recent batches of a query (Spark keeps the
    last hundred; ``MetricsListener`` sees all)."""
    totals: dict[str, int] = {}
    for progress in query.recentProgress:
        row = progress["observedMetrics"].get(name)
        for k, v in (row.asDict() if hasattr(row, "asDict") else row or {}).items():
            totals[k] = totals.get(k, 0) + (v or 0)
    return totals


def land_batch(batch: DataFrame, dest: str, batch_id: int, key: str = "event_id", quarantine: str | None = None) -> int:
    """Insert the rows of a batch whose ids the table lacks; returns how many.

    Each batch owns the folders ``event_date=<day>/batch=<id>``: a batch that is
    replayed after a failure overwrites what it wrote before and ignores it when
    it looks for known ids, so the outcome is the same however often it runs.
    Rows without an instant go to ``quarantine`` (or stop the stream): no day
    would ever match them, and each replay would add them again.
    """
    spark = batch.sparkSession
    batch = batch.persist()
    try:
        one = batch.agg(F.count_if(F.col(key).isNull()).alias("lost"), F.count_if(F.col("created_at").isNull()).alias("undated"), F.collect_set("event_date").alias("days")).first()
        if one["lost"]:
            raise StreamRejected(f"{one['lost']} events without an id")
        if one["undated"]:
            if quarantine is None:
                raise StreamRejected(f"{one['undated']} events without an instant")
            batch.where("created_at is null").write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")
        order = [F.col(c).asc_nulls_last() for c in ("ingested_at", "actor_login", "event_type")]
        rows = batch.where("created_at is not null").withColumn("__n", F.row_number().over(_by(key).orderBy(*order))).where("__n = 1").drop("__n")
        known = _known_ids(spark, dest, one["days"], batch_id, key)
        if known is not None:
            rows = rows.join(known, key, "left_anti")
        rows = rows.withColumn("batch", F.lit(batch_id)).persist()
        count = rows.count()
        for day in one["days"]:  # the days of one batch
            _drop(spark, f"{dest}/event_date={day}/batch={batch_id}")
        rows.write.partitionBy("event_date", "batch").mode("append").parquet(dest)
        rows.unpersist()
        return count
    finally:
        batch.unpersist()


def _by(key: str):
    from pyspark.sql import Window

    return Window.partitionBy(key)


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _drop(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def _known_ids(spark: SparkSession, dest: str, days: list[str], batch_id: int, key: str) -> DataFrame | None:
    p, fs = _path(spark, dest)
    if not days or not fs.exists(p) or not any(s.isDirectory() and s.getPath().getName().startswith("event_date=") for s in fs.listStatus(p)):
        return None
    schema = f"{key} string, event_date string, batch long"
    table = spark.read.schema(schema).option("basePath", dest).parquet(dest)
    span = (F.col("event_date") >= min(days)) & (F.col("event_date") <= max(days))
    return table.where(span & (F.col("batch") != batch_id)).select(key)


def write_stream(silver: DataFrame, dest: str, checkpoint: str, available_now: bool = True, quarantine: str | None = None, seconds: int = 10) -> StreamingQuery:
    """Start landing ``silver`` in ``dest``."""
    writer = silver.writeStream.foreachBatch(lambda batch, i: land_batch(batch, dest, i, quarantine=quarantine) and None).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{seconds} seconds")).start()


def read_silver(spark: SparkSession, dest: str) -> DataFrame:
    return spark.read.option("basePath", dest).option("spark.sql.sources.partitionColumnTypeInference.enabled", "false").parquet(dest).drop("batch").withColumn("event_date", F.col("event_date").cast("string"))


def run_stages(*stages: Callable[[], object]) -> list[object]:
    """Run stages one after the other; the first failure stops the rest."""
    return reduce(lambda done, stage: [*done, stage()], stages, [])
