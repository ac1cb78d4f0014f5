"""Sharding by longest-processing-time scheduling.

Groups that must stay together (rows of equal text) are taken largest first;
each goes to the shard with the least bytes so far, kept in a heap.

Groups of equal size are interchangeable, so the schedule is computed over
size classes (size, number of groups): how many groups of a class go to each
shard is exactly what taking them one by one would give.  Distinct sizes that
add up to ``total`` bytes are fewer than ``sqrt(2 * total)``, whatever the
number of groups; texts have some 10,000 to 100,000 of them.  The driver holds
one row for each class.  The members of a class are dealt by their rank in the
order of digests, so reruns agree.

Nulls: a null text has size 1 and no checksum; null texts count as equal, so
they stay together.  Empty texts have size 1 and checksum 0.  Repeated rows
are rows of one group.  Ties in size go in the order of digests, ties in load
to the lower shard.  Null and repeated ids are kept: each row has a slot of its
own.  Other columns of the table are not looked at.  Empty tables give an empty
result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import scratch
from .ranking import with_rank

#: Size classes up to this number are broadcast (8 bytes a shard each).
BROADCAST_CLASSES = 200_000


def lpt(sizes: list[tuple[int, object]], shards: int) -> dict[object, int]:
    """Shard of each key: largest first, to the least-loaded shard (ties: the
    lower shard); equal sizes go in the order of their keys."""
    heap = [(0, k) for k in range(shards)]
    placed = {}
    for size, key in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(heap)
        placed[key] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def lpt_classes(sizes: np.ndarray, counts: np.ndarray, shards: int) -> np.ndarray:
    """(classes, shards): how many groups of each class the schedule puts into
    each shard.  ``sizes`` are distinct, positive and descending.

    Few groups go through the heap one by one.  Of many, each shard first takes
    as many as keep its load within the level that the class reaches at least;
    the heap deals the rest, at most two for each shard.
    """
    heap = [(0, k) for k in range(shards)]
    out = np.zeros((len(sizes), shards), np.int64)
    for c, (size, count) in enumerate(zip(sizes.tolist(), counts.tolist())):
        if count > 4 * shards:
            load = np.zeros(shards, object)
            for value, k in heap:
                load[k] = value
            low, high = int(min(load)), int(max(load)) + size * (count // shards + 2)
            while low < high:  # the highest level that takes no more than there are
                level = (low + high + 1) // 2
                if sum(max(0, (level - x) // size) for x in load) <= count:
                    low = level
                else:
                    high = level - 1
            first = [max(0, (low - x) // size) for x in load]
            # the last one of each shard goes through the heap, which settles ties
            first = [max(0, n - 1) for n in first]
            out[c] += np.array(first, np.int64)
            heap = [(int(x) + n * size, k) for k, (x, n) in enumerate(zip(load, first))]
            heapq.heapify(heap)
            count -= sum(first)
        for _ in range(count):
            value, k = heapq.heappop(heap)
            out[c, k] += 1
            heapq.heappush(heap, (value + size, k))
    return out


def assign_shards(rows: DataFrame, group: str, size: str, shards: int = 16) -> DataFrame:
    """``rows`` plus ``shard``: rows of equal ``group`` (binary, not null) share
    one, and groups go to shards as ``lpt`` over their sums of ``size`` (positive)
    puts them.  ``rows`` should be written already; they have no columns named
    __size, __rank, __first or __ends."""
    spark = rows.sparkSession
    groups = rows.groupBy(group).agg(F.sum(size).alias("__size"))
    ranked = with_rank(groups, ["__size", group], "__rank")
    classes = ranked.groupBy("__size").agg(F.count("*").alias("n"), F.min("__rank").alias("__first"))
    got = classes.toArrow().sort_by([("__size", "descending")])  # one row for each distinct size
    ends = np.cumsum(lpt_classes(got["__size"].to_numpy(), got["n"].to_numpy(), shards), axis=1)
    ends = pa.FixedSizeListArray.from_arrays(pa.array(ends.ravel()), shards).cast(pa.list_(pa.int64()))
    plan = spark.createDataFrame(pa.table({"__size": got["__size"], "__first": got["__first"], "__ends": ends}))
    if got.num_rows <= BROADCAST_CLASSES:
        plan = F.broadcast(plan)
    place = F.col("__rank") - F.col("__first")
    shard = F.size(F.filter("__ends", lambda end: end <= place))
    placed = scratch.table(ranked.join(plan, "__size").select(group, shard.alias("shard")), "placed")
    return rows.join(placed, group)  # both sides are scans, so a group of many rows can be split


def digest(text: Column) -> Column:
    """16 bytes that stand for a text; null has a value of its own."""
    return F.coalesce(F.unhex(F.md5(text.cast("binary"))), F.lit(bytearray(b"null")))


def text_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(1)).cast("long")


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, size, text_crc32, law (``bytes``), shard,
    slot (0, 1, ... within the shard, in the order of ids, nulls first) and
    grown_shard (null: this law moves rows when shards are added)."""
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        text_size(text).alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        digest(text).alias("__group"),
    )
    rows = scratch.table(rows, "sizes")
    placed = assign_shards(rows, "__group", "size", shards).drop("__group")
    ranked = with_rank(placed, ["shard", "doc_id", "text_crc32"])
    first = ranked.groupBy("shard").agg(F.min("rank").alias("__first"))
    return ranked.join(F.broadcast(first), "shard").select(  # one row for each shard
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("rank") - F.col("__first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


__all__ = ["assign_shards", "digest", "lpt", "lpt_classes", "shard_documents", "text_size"]
