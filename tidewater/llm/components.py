"""Connected components of a graph of ids, as joins and minimum aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``edges``: a, b (long).  Returns id, component: the smallest id reachable.

    Each round gives every id the least label among its own and its neighbours'
    and then the label of that label, so chains shorten by halves.  Minima are
    aggregated before they are shuffled, so hub ids do not gather in a task.
    """
    both = edges.select("a", "b").where("a != b")
    both = scratch.table(both.union(both.select("b", "a")).distinct(), "links")
    labels = scratch.table(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("l")), "labels")
    for _ in range(rounds):
        near = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("l").alias("m"))
        low = labels.join(near, labels["id"] == near["a"], "left").select("id", F.least("l", F.coalesce("m", "l")).alias("n"), "l")
        jump = labels.select(F.col("id").alias("j"), F.col("l").alias("jl"))
        step = low.join(jump, low["n"] == jump["j"], "left").select("id", F.least("n", F.coalesce("jl", "n")).alias("n"), "l")
        done = scratch.table(step, "labels")
        changed = done.where("n != l").limit(1).count()
        labels = done.select("id", F.col("n").alias("l"))
        if not changed:
            return labels.select("id", F.col("l").alias("component"))
    raise RuntimeError(f"components did not settle in {rounds} rounds")
