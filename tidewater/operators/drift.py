"""Drift between two frames: schema, missing values, shifted distributions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ranks import quantiles

# Fixed values.
FLOOR = 1e-6
MODERATE, MAJOR = 0.1, 0.25
ALL_NULL = 0.99


def psi(expected: Column, actual: Column) -> Column:
    """What one bin's two shares add to the population stability index; a share
    below ``FLOOR``, or none, counts as ``FLOOR``."""
    at_least = lambda c: F.greatest(F.coalesce(c, F.lit(0.0)), F.lit(FLOOR))
    return (at_least(actual) - at_least(expected)) * F.log(at_least(actual) / at_least(expected))


def numeric(schema: T.StructType, column: str) -> bool:
    return isinstance(schema[column].dataType, T.NumericType)


def edges(frame: DataFrame, columns: list[str], bins: int = 10) -> dict[str, list[float]]:
    """Inner quantile edges of each numeric column: exact, from counts of its
    distinct values."""
    at = {f"p{k}": k / bins for k in range(1, bins)}
    found = {c: quantiles(frame.select(F.col(c).cast("double").alias("v")), "v", at, [], interpolate=True).first() for c in columns}
    return {c: sorted({x for x in row if x is not None}) if row else [] for c, row in found.items()}


def _bin(column: str, cuts: list[float] | None) -> Column:
    if cuts is None:
        return F.col(column).cast("string")
    value = F.col(column).cast("double")
    return F.size(F.filter(F.array(*[F.lit(float(x)) for x in cuts]).cast("array<double>"), lambda e: e < value)).cast("string")


def shares(frame: DataFrame, cuts: dict[str, list[float] | None]) -> DataFrame:
    """column, bin, share of the column's non-null values: the number of the
    interval for given cuts, else the value.  All columns in one aggregate."""
    bins = [F.struct(F.lit(c).alias("column"), F.when(F.col(c).isNotNull(), _bin(c, at)).alias("bin")) for c, at in cuts.items()]
    rows = frame.select(F.explode(F.array(*bins)).alias("b")).select("b.*").where("bin is not null")
    counts = rows.groupBy("column", "bin").agg(F.count("*").alias("n"))
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(totals), "column").select("column", "bin", (F.col("n") / F.col("total")).alias("share"))  # a row a column


def null_shares(frame: DataFrame, columns: list[str]) -> dict[str, float]:
    one = frame.agg(F.count("*").alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    return {c: one[c] / one["__n"] if one["__n"] else 0.0 for c in columns}


def stability(reference: DataFrame, current: DataFrame, cuts: dict[str, list[float] | None]) -> DataFrame:
    """column, psi: one row for each column, however many values it has."""
    old = shares(reference, cuts).select("column", "bin", F.col("share").alias("e"))
    new = shares(current, cuts).select(F.col("column").alias("c"), F.col("bin").alias("b"), F.col("share").alias("a"))
    both = old.join(new, (F.col("column") == F.col("c")) & (F.col("bin") == F.col("b")), "full")
    return both.groupBy(F.coalesce("column", "c").alias("column")).agg(F.sum(psi(F.col("e"), F.col("a"))).alias("psi"))


def compare(reference: DataFrame, current: DataFrame, columns: list[str], bins: int = 10) -> list[dict]:
    """column, kind (schema, covariate, none), verdict (missing, all_null, type,
    major, moderate, stable) and psi of each column.  A schema finding goes before
    a shift.  Quantile edges come from the reference and serve both frames.  A
    column without values in either frame is stable with psi 0."""
    there = [c for c in columns if c in reference.columns]
    both = [c for c in there if c in current.columns]
    nulls, old_nulls = null_shares(current, both), null_shares(reference, both)
    broken = {}
    for c in columns:
        if c not in both:
            broken[c] = "missing"
        elif numeric(reference.schema, c) != numeric(current.schema, c):
            broken[c] = "type"
        elif nulls[c] >= ALL_NULL > old_nulls[c]:
            broken[c] = "all_null"
    fine = [c for c in columns if c not in broken]
    numbers = edges(reference, [c for c in fine if numeric(reference.schema, c)], bins)
    found = {r["column"]: r["psi"] for r in stability(reference, current, {c: numbers.get(c) for c in fine}).collect()} if fine else {}
    out = []
    for c in columns:
        if c in broken:
            out.append({"column": c, "kind": "schema", "verdict": broken[c], "psi": None})
        else:
            value = found.get(c, 0.0)
            verdict = "major" if value >= MAJOR else "moderate" if value >= MODERATE else "stable"
            out.append({"column": c, "kind": "none" if verdict == "stable" else "covariate", "verdict": verdict, "psi": value})
    return out


def missing_values(row: dict) -> list[str]:
    """Names of the features of one vector that are null or not a number."""
    return [k for k, v in row.items() if v is None or isinstance(v, float) and math.isnan(v)]


def missing_names(schema: T.StructType, columns: list[str]) -> Column:
    """``missing_values`` as a column of a row's own features, in their order."""
    odd = lambda c: F.col(c).isNull() | F.isnan(F.col(c)) if isinstance(schema[c].dataType, (T.FloatType, T.DoubleType)) else F.col(c).isNull()
    return F.array_compact(F.array(*[F.when(odd(c), F.lit(c)) for c in columns]))
