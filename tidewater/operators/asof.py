"""Point-in-time joins and running histories, linear in the rows of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_of_join(spine: DataFrame, log: DataFrame, on: list[str], spine_time: str, log_time: str, tiebreak: list[str] | None = None, slice_seconds: int | None = None) -> DataFrame:
    """Each row of ``spine`` with the columns of the last row of ``log`` of the
    same keys whose time is strictly before the spine's.

    Both sides become one timeline; the last log row is carried forward whole,
    so a null in it stays null.  At equal times spine rows come first, which
    makes the comparison strict.  Every spine row survives once: rows without a
    match, and rows with a null key or time, get nulls.  Of log rows with equal
    key and time the last in the order of ``tiebreak`` (else of all values) wins.

    Plainly, all rows of a key are sorted in one task, and one exchange does.
    With ``slice_seconds`` the timeline of a key is cut into slices of time that
    are sorted apart; a slice begins with the last log row of those before it, of
    which there is one row a slice.  The result is the same; use it where one key
    may hold a large part of all rows (times are timestamps then).
    """
    own, values = spine.columns, [c for c in log.columns if c not in (*on, log_time)]
    left = spine.select(*[F.col(c).alias(f"s_{i}") for i, c in enumerate(own)])
    number = {c: f"s_{i}" for i, c in enumerate(own)}
    usable = F.lit(True)
    for c in (*on, spine_time):
        usable &= F.col(number[c]).isNotNull()
    order = F.struct(*[F.col(c) for c in tiebreak or values]) if tiebreak or values else F.struct(F.lit(0))
    row = F.struct(*[F.col(c) for c in values]) if values else F.struct(F.lit(1).alias("hit"))
    log = log.dropna(subset=[*on, log_time])
    right = log.select(*[F.col(c).alias(f"k_{c}") for c in on], F.col(log_time).alias("t"), F.lit(1).alias("side"), order.alias("o"), row.alias("row"))
    timeline = left.where(usable).select(*[F.col(number[c]).alias(f"k_{c}") for c in on], F.col(number[spine_time]).alias("t"), F.lit(0).alias("side"), F.struct(*left.columns).alias("s"))
    timeline = timeline.unionByName(right, allowMissingColumns=True)
    keys = [f"k_{c}" for c in on]
    before = lambda *by: Window.partitionBy(*by).orderBy("t", "side", "o").rowsBetween(Window.unboundedPreceding, -1)
    if slice_seconds is None:
        carried = timeline.withColumn("hit", F.last("row", ignorenulls=True).over(before(*keys))).where("side = 0")
    else:
        timeline = timeline.withColumn("slice", F.floor(F.unix_timestamp("t") / slice_seconds))
        # a row for each key and slice: its last log row, and from that the last one before the slice
        ends = timeline.groupBy(*keys, "slice").agg(F.max_by("row", F.when(F.col("side") == 1, F.struct("t", "o"))).alias("end"))
        earlier = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        ends = ends.select(*keys, "slice", F.last("end", ignorenulls=True).over(earlier).alias("brought"))
        inside = timeline.withColumn("own", F.last("row", ignorenulls=True).over(before(*keys, "slice"))).where("side = 0")
        carried = inside.join(ends, [*keys, "slice"]).withColumn("hit", F.coalesce("own", "brought"))
    out = [F.col(f"s.s_{i}").alias(c) for i, c in enumerate(own)] + [F.col(f"hit.{c}").alias(c) for c in values]
    lost = left.where(~usable).select(*[F.col(f"s_{i}").alias(c) for i, c in enumerate(own)], *[F.lit(None).cast(log.schema[c].dataType).alias(c) for c in values])
    return carried.select(*out).unionByName(lost)


def running(rows: DataFrame, keys: list[str], time: str, **sums: Column) -> DataFrame:
    """keys, time and running sums over all rows up to and with each instant; one
    row an instant.  Rows of one instant are summed first, so the window has a
    row an instant and ties need no settling."""
    instants = rows.groupBy(*keys, time).agg(*[F.sum(c).alias(name) for name, c in sums.items()])
    frame = Window.partitionBy(*keys).orderBy(time).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return instants.select(*keys, time, *[F.sum(name).over(frame).alias(name) for name in sums])


def rolling(events: DataFrame, entity: str, time: str = "created_at", id_column: str = "event_id") -> DataFrame:
    """entity, event_time (the event's instant) and what was known strictly
    before that second: events in the last hour and day, seconds since the last
    event, hourly arrival rate over a day.  Null where there is no earlier event."""
    rows = events.where(F.col(entity).isNotNull() & F.col(time).isNotNull())
    rows = rows.select(F.col(entity), F.col(time).alias("event_time"), F.unix_timestamp(F.col(time).cast("timestamp")).alias("__s"), F.col(id_column))
    line = Window.partitionBy(entity).orderBy("__s")
    prior = lambda n: F.count("*").over(line.rangeBetween(-n, -1))
    last = F.max("__s").over(line.rangeBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumns({"__last": last, "__h": prior(3600), "__d": prior(86400)})
    known = F.col("__last").isNotNull()
    return rows.select(
        entity,
        "event_time",
        id_column,
        F.when(known, F.col("__h")).alias("events_prior_1h"),
        F.when(known, F.col("__d")).alias("events_prior_24h"),
        (F.col("__s") - F.col("__last")).cast("double").alias("secs_since_last_event"),
        F.when(known, F.col("__d") / F.lit(24.0)).alias("arrival_per_hour_24h"),
    )
