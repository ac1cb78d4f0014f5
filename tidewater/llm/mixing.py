"""Mixing sources to target weights by systematic sampling.

Every document expects ``target / source size`` copies.  Within its source the
expected copies are summed up in the order of (size, id), one random offset is
added, and the document is emitted once for each integer that its stretch of
the sum crosses.  The order by size makes the sample stratified, so that the
words taken come near the target.

Expected copies are fixed-point integers (2**-28), so sums are exact and reruns
agree whatever the order in which executors add.

Nulls: a null source is a source of its own, sorted last; a null text has size
0.  Documents of size 0 take nothing.  Repeated rows are documents of their
own.  Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import scratch
from .ranking import with_rank

UNIT = 1 << 28
#: So many sources at most are broadcast; beyond, they are joined by shuffle.
BROADCAST_SOURCES = 200_000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``sizes``: source, source_size (one row per source; the number of sources
    is small).  Adds ``target``: ``share`` of all sizes by weight, with no target
    over ``most`` times its source; the excess goes to the others by weight.

    Weights repeat over sources in code-point order, null last.  The fixed point
    of that resharing is ``min(most * size, level * weight)``, and ``level``
    follows from running sums over the sources ordered by size per weight.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    ranked = sizes.withColumn("__w", weight).withColumn("__cap", F.lit(most) * F.col("source_size"))
    everything = Window.partitionBy()
    ranked = ranked.withColumn("__all", F.sum("source_size").over(everything) * F.lit(share))
    by_cap = Window.orderBy(F.col("__cap") / F.col("__w"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    capped = F.coalesce(F.sum("__cap").over(before), F.lit(0.0))
    rest = F.sum("__w").over(everything) - F.coalesce(F.sum("__w").over(before), F.lit(0.0))
    # the level if exactly the sources before this one were capped; the first
    # source that stays below its cap at its own level fixes the level of all
    ranked = ranked.withColumn("__level", (F.col("__all") - capped) / rest)
    fits = F.col("__level") * F.col("__w") <= F.col("__cap")
    ranked = ranked.withColumn("__fixed", F.first(F.when(fits, F.col("__level")), True).over(by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.when(F.col("__fixed").isNull(), F.col("__cap")).otherwise(F.least("__cap", F.col("__fixed") * F.col("__w")))
    return ranked.select("source", "source_size", target.cast("double").alias("target"))


def mix(docs: DataFrame, seed: int = 17, **rule) -> DataFrame:
    """Per document: doc_id, size, source_size, target, copies, taken (and source)."""
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return sample_to_targets(scratch.table(rows, "sizes"), seed=seed, **rule)  # texts are counted once, not once a pass


def sample_to_targets(rows: DataFrame, seed: int = 17, keep: tuple[str, ...] = (), **rule) -> DataFrame:
    """``rows``: doc_id, source, size.  Systematic sampling to the targets of
    ``source_targets(**rule)``.  The columns ``keep`` of ``rows`` are returned too."""
    ranked = with_rank(rows, ["source", "size", "doc_id"])
    per = ranked.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("rank").alias("__first"))
    targets = source_targets(per.select("source", "source_size"), **rule)
    per = per.select(F.col("source").alias("s"), "__first").join(
        targets.withColumnRenamed("source", "t"), F.col("s").eqNullSafe(F.col("t"))
    )
    each = F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)) * UNIT)
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), "s"), F.lit("null")))
    offset = F.conv(F.substring(F.md5(named.cast("binary")), 1, 7), 16, 10).cast("long")  # 28 bits
    per = per.select("s", "__first", "source_size", "target", each.cast("long").alias("__each"), offset.alias("__offset"))
    per = scratch.table(per, "targets")
    if per.count() <= BROADCAST_SOURCES:
        per = F.broadcast(per)
    joined = ranked.join(per, F.col("source").eqNullSafe(F.col("s")))
    start = F.col("__offset") + (F.col("rank") - F.col("__first")) * F.col("__each")
    copies = F.shiftright(start + F.col("__each"), 28) - F.shiftright(start, 28)
    return joined.select(
        "doc_id",
        "source",
        "size",
        F.col("source_size").cast("long").alias("source_size"),
        "target",
        copies.cast("int").alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"),
        *keep,
    )
