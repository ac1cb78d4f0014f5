"""Exact global ranks without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import scratch

_LOW = (1 << 33) - 1


def with_rank(df: DataFrame, order: list[str], name: str = "rank", partitions: int | None = None) -> DataFrame:
    """Add the 0-based position of each row in the order of ``order`` (nulls first).

    Rows are range-partitioned and sorted within partitions, then written once:
    a row's position is its place in its partition plus the rows of earlier
    partitions.  Only one count per partition meets in one place.  Ties take
    consecutive positions in any order.  ``order`` should be unique enough that
    no value holds more rows than a task can sort.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys: list[Column] = [F.col(c).asc_nulls_first() for c in order]
    dealt = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    placed = scratch.table(dealt.withColumn("__at", F.monotonically_increasing_id()), "ranked")
    part, row = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit(_LOW))
    counts = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")  # one row for each partition
        .withColumn(name, F.col("__before") + row)
        .drop("__part", "__before", "__at")
    )
