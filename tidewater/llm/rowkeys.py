"""Rows told apart by a key of their own, and decisions brought back to them.

Ids may be null or repeat, so a stage that decides row by row first writes its
input with a key for each row (``numbered``).  Decisions, one small number for
each key, come back by ``attach`` as one byte a row: keys are packed in blocks
of consecutive rows, and the table of blocks is broadcast under a size check,
so that texts are not shuffled for a decision about them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import scratch

#: Rows of a block: 2**BLOCK_BITS.
BLOCK_BITS = 12
#: Tables of blocks up to this size are broadcast; larger ones are joined by shuffle.
BROADCAST_BYTES = 64 << 20


def free(columns: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores in front as keep it from clashing
    with a column (names compare as Spark compares them, whatever their case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def numbered(rows: DataFrame, key: str, **more: Column) -> DataFrame:
    """``rows`` written to the shared folder with a distinct long ``key`` for
    each row (consecutive within a task) and the columns ``more``."""
    return scratch.table(rows.withColumns({key: F.monotonically_increasing_id(), **more}), "numbered")


def attach(rows: DataFrame, key: str, decisions: DataFrame, value: str) -> DataFrame:
    """``rows`` (of ``numbered``) plus ``value``.  ``decisions``: key and value
    (0 to 127, not null), one row for every key of ``rows``."""
    block, codes = free(rows.columns, "__block", "__codes")
    low = F.col(key).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))
    high = F.shiftright(F.col(key), BLOCK_BITS)
    cells = F.sort_array(F.collect_list(F.struct(low.alias("at"), F.col(value).cast("tinyint").alias("v"))))
    packed = decisions.groupBy(high.alias(block)).agg(F.transform(cells, lambda c: c["v"]).alias(codes))
    packed = scratch.table(packed, "decisions")
    size = packed.agg(F.sum(F.size(codes) + 64)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        packed = F.broadcast(packed)
    found = rows.withColumn(block, high).join(packed, block)
    return found.withColumn(value, F.get(F.col(codes), low.cast("int"))).drop(block, codes)
