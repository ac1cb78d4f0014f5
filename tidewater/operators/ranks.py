"""Exact ranks and quantiles from counts of distinct values, in ranges of values,
so that no task sorts all rows and no buffer holds all values of a group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Ranges between a number and its double.
RANGES = 4096
#: Rows that one task numbers at most when ties are told apart.
TIES = 1_000_000


def range_of(value: Column) -> Column:
    """A whole number that never falls as the value rises, with ``RANGES`` steps from
    a number to its double; null for null."""
    v = value.cast("double")
    size = F.abs(v)
    power = F.floor(F.log2(size))
    step = (power + 2000) * RANGES + F.floor(size / F.pow(F.lit(2.0), power) * RANGES)
    found = F.when(F.isnan(v), F.lit(1 << 40)).when(v == 0, F.lit(0)).when(v > 0, step).otherwise(-step)
    return F.when(v.isNotNull(), found.cast("long"))


def counted(rows: DataFrame, value: str, groups: list[str], **sums: Column) -> DataFrame:
    """groups, value, n (rows with it), start (rows of the group with smaller values),
    total (rows of the group), and for each further sum its sum and, as
    ``<name>_start``, that over smaller values.  Null values are left out."""
    per = rows.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count("*").alias("n"), *[F.sum(c).alias(k) for k, c in sums.items()])
    names = ["n", *sums]
    per = per.withColumn("__range", range_of(F.col(value)))
    same = lambda a, b: [a[g].eqNullSafe(b[f"__{g}"]) for g in groups]
    parts = per.groupBy(*groups, "__range").agg(*[F.sum(c).alias(c) for c in names])
    line = Window.partitionBy(*groups).orderBy("__range")  # a row for each range
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        *[F.col(g).alias(f"__{g}") for g in groups],
        F.col("__range").alias("__r"),
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"__before_{c}") for c in names],
        F.sum("n").over(Window.partitionBy(*groups)).alias("total"),
    )
    joined = per.join(parts, [*same(per, parts), per["__range"] == parts["__r"]])
    inside = Window.partitionBy(*groups, "__range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    starts = [(F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"__before_{c}")).alias("start" if c == "n" else f"{c}_start") for c in names]
    return joined.select(*groups, value, *names, *starts, "total")


def quantiles(rows: DataFrame, value: str, at: dict[str, float], groups: list[str], interpolate: bool = False) -> DataFrame:
    """groups and one column for each share of ``at``: the smallest value that at
    least that share of the rows do not exceed; with ``interpolate``, the value at
    that share of the way between the first row and the last."""
    found = counted(rows, value, groups)
    end = F.col("start") + F.col("n")
    row = lambda r: F.max(F.when((F.col("start") <= r) & (r < end), F.col(value)))
    out = []
    for name, p in at.items():
        if interpolate:
            place = F.lit(float(p)) * (F.col("total") - 1)
            low, high = row(F.floor(place)), row(F.ceil(place))
            out.append((low + (high - low) * F.max(place - F.floor(place))).alias(name))
        else:
            out.append(row(F.greatest(F.ceil(F.lit(float(p)) * F.col("total")), F.lit(1)) - 1).alias(name))
    return found.groupBy(*groups).agg(*out)


def select_at(rows: DataFrame, keys: list[str], ranks: Callable[[Column], Column]) -> list[tuple]:
    """The keys of the rows at some places (from 0) in the order of ``keys``, which
    tell rows apart and are not null; ``ranks`` makes the array of places from the
    number of rows.  Counts of the first key say which of its values holds each
    place; only the rows of these values are looked at again, by the next key, and
    a window ends the search once they are few.  One row for each place comes to
    the driver at each step."""
    held = lambda places, at: F.filter(places, lambda x: (at(x) >= F.col("start")) & (at(x) < F.col("start") + F.col("n")))
    counts = counted(rows, keys[0], []).withColumn("__places", held(ranks(F.col("total")), lambda x: x))
    hits = counts.where(F.size("__places") > 0).select(keys[0], "start", "n", "__places").collect()
    found = [((h[keys[0]],), r - h["start"], h["n"]) for h in hits for r in h["__places"]]
    for depth in range(1, len(keys)):
        if not found:
            break
        by, column = keys[:depth], keys[depth]
        known = rows.sparkSession.createDataFrame(sorted({p for p, _, _ in found}), rows.select(*by).schema)
        some = rows.join(F.broadcast(known), by, "left_semi")  # a row for each place at most
        places = F.array(*[F.struct(*[F.lit(x).cast(rows.schema[c].dataType).alias(c) for x, c in zip(p, by)], F.lit(r).cast("long").alias("__place")) for p, r, _ in found])
        if max(n for _, _, n in found) <= TIES:
            line = some.select(*keys, (F.row_number().over(Window.partitionBy(*by).orderBy(*keys[depth:])) - 1).cast("long").alias("__place"))
            return sorted(tuple(h[c] for c in keys) for h in line.where(F.array_contains(places, F.struct(*by, "__place"))).collect())
        counts = counted(some, column, by).withColumn("__places", held(_of(places, by), lambda x: x["__place"]))
        hits = counts.where(F.size("__places") > 0).select(*by, column, "start", "n", F.transform("__places", lambda x: x["__place"]).alias("__places")).collect()
        found = [(tuple(h[c] for c in [*by, column]), r - h["start"], h["n"]) for h in hits for r in h["__places"]]
    return sorted(p for p, _, _ in found)


def _of(places: Column, columns: list[str]) -> Column:
    """The places among the rows of this row's prefix."""
    return F.filter(places, lambda place: _same(place, columns))


def _same(place: Column, columns: list[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out &= place[c] == F.col(c)
    return out


def ntile(rows: DataFrame, groups: int, keys: list[str], name: str) -> DataFrame:
    """``rows`` plus the number, from 1, of each row's share when they are cut into
    ``groups`` in the order of ``keys``, as the window function does.  The rows at
    which groups begin are selected first; then a row's group is how many of
    these do not come after it."""
    begin = lambda total: F.transform(F.sequence(F.lit(1), F.lit(groups - 1)), lambda k: k * F.floor(total / groups) + F.least(k.cast("long"), total % groups))
    begins = lambda total: F.filter(F.array_distinct(begin(total)), lambda b: (b > 0) & (b < total))
    edges = select_at(rows, keys, begins) if groups > 1 else []
    row = F.struct(*keys)
    begun = F.array(*[F.struct(*[F.lit(x).cast(rows.schema[c].dataType).alias(c) for x, c in zip(edge, keys)]) for edge in edges])
    number = F.size(F.filter(begun, lambda edge: edge <= row)) + 1 if edges else F.lit(1)
    return rows.withColumn(name, number.cast("long"))
