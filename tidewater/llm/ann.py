"""Nearest neighbours: a hierarchical k-means tree with best-bin-first search.

The tree is trained on a bounded sample.  Every vector is assigned to a leaf.
A query visits leaves in best-bin-first order: a priority queue over unexplored
branches, nearest first.  How many leaves it visits is calibrated: for half of
``probes`` queries the true neighbours among all rows are found by brute force,
and the visits widen until ``recall`` of them lie in the visited leaves; the
other half measures the recall, which every row of the result states.

A leaf's rows and its queries are both cut into parts of ``PART_BYTES`` of
vectors, by a number of their own, and each pair of parts is a group of the
shuffle: no group outgrows that bound however many rows or queries fall into a
leaf, or share an id.

Vectors that are null, zero, or hold nulls, non-finite values or another
number of components than most, take no part, nor do rows with a null id.
Rows with equal ids are no candidates for each other; an id that repeats may be
found once for each of its rows.  Ties go to the smaller id; equal vectors are
told apart by their ids alone.  Distances too large for a double are infinite
and rank last, ties by id.  Other columns of the table are not looked at.  An
empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import scratch
from .labelled import first_by_hash

#: Bytes of the vectors on either side of a group.
PART_BYTES = 16 << 20
#: The tree sees components within these bounds, so that their squares are finite.
_MOST = 1e100


def valid_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and v (array<double>) of the rows that take part."""
    some = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    some = some.where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
    some = some.where(~F.exists("v", bad) & F.exists("v", lambda x: x != 0))
    widths = some.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").limit(1).collect()
    return some.where(F.size("v") == (widths[0]["w"] if widths else 0))


def matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, steps: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Centres (at most k) and the centre of each row."""
    centres = np.unique(x[rng.choice(len(x), min(k, len(x)), replace=False)], axis=0)
    for _ in range(steps):
        own = nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        counts = np.bincount(own, minlength=len(centres))
        centres = (sums / np.maximum(counts, 1)[:, None])[counts > 0]
    return centres, nearest(x, centres)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)


class Tree:
    """Nodes: (centres, children); a child is a node's number or ~leaf."""

    def __init__(self, x: np.ndarray, leaves: int, branching: int = 16, seed: int = 4) -> None:
        self.nodes: list[tuple[np.ndarray, list[int]]] = []
        self.leaves, self._rng, self._b = 0, np.random.default_rng(seed), branching
        self._most = max(1, len(x) // leaves)
        self._grow(np.clip(x, -_MOST, _MOST))
        del self._rng

    def _grow(self, x: np.ndarray) -> int:
        k = min(self._b, max(2, round(len(x) / self._most)))
        centres, own = kmeans(x, k, self._rng)
        at = len(self.nodes)
        self.nodes.append((centres, []))
        for c in range(len(centres)):
            part = x[own == c]
            if len(centres) > 1 and len(part) > 1.5 * self._most:
                child = self._grow(part)
            else:
                child, self.leaves = ~self.leaves, self.leaves + 1
            self.nodes[at][1].append(child)
        return at

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        x = np.clip(x, -_MOST, _MOST)
        out, todo = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            centres, children = self.nodes[node]
            own = nearest(x[rows], centres)
            for c, child in enumerate(children):
                part = rows[own == c]
                if len(part) and child < 0:
                    out[part] = ~child
                elif len(part):
                    todo.append((child, part))
        return out

    def order(self, q: np.ndarray, visits: int | None = None) -> list[int]:
        """The first ``visits`` leaves, best bin first."""
        return list(islice(self.bins(q), visits))

    def bins(self, q: np.ndarray) -> Iterator[int]:
        """All leaves, best bin first."""
        q = np.clip(q, -_MOST, _MOST)
        heap = [(0.0, 0)]
        while heap:
            _, at = heapq.heappop(heap)
            if at < 0:
                yield ~at
                continue
            centres, children = self.nodes[at]
            for d, child in zip(((centres - q) ** 2).sum(axis=1), children):
                heapq.heappush(heap, (float(d), child))


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of ``x`` from ``q``; where squares leave the
    range of doubles the differences are scaled first."""
    with np.errstate(over="ignore", invalid="ignore"):
        out = np.sqrt(((x - q) ** 2).sum(axis=1))
        for i in np.flatnonzero(~np.isfinite(out)):
            half = np.abs(x[i] / 2 - q / 2)
            most = half.max()
            out[i] = np.sqrt(((half / most) ** 2).sum()) * most * 2
    return out


def top(queries: np.ndarray, qids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, distance) of the k nearest rows of ``x`` for each query,
    ties to the smaller id; a query's own id is left out."""
    rows = np.lexsort((ids,))
    x, ids, out = x[rows], ids[rows], ([], [], [])
    most = max(np.abs(x).max(initial=0.0), np.abs(queries).max(initial=0.0))
    shrink = 2.0 ** -int(np.log2(most)) if most > 1e140 else 1.0  # squares of rough values stay finite
    small = x * shrink
    norms = (small**2).sum(axis=1)
    for at in range(0, len(queries), 64):
        q, own = queries[at : at + 64], qids[at : at + 64]
        scaled = q * shrink
        rough = norms - 2 * scaled @ small.T
        self_ = own[:, None] == ids[None, :]
        rough[self_] = np.inf
        # the rough values only choose whose exact distances are computed: all within rounding of the k-th
        kth = np.partition(rough, k - 1, axis=1)[:, k - 1] if k < len(x) else np.full(len(q), np.inf)
        slack = 1e-9 * (norms.max() + (scaled**2).sum(axis=1) + 1)
        for i in range(len(q)):
            near = np.flatnonzero((rough[i] <= kth[i] + slack[i]) & ~self_[i])
            exact = distances(x[near], q[i])
            best = np.lexsort((ids[near], exact))[:k]
            out[0].append(np.full(len(best), own[i]))
            out[1].append(ids[near][best])
            out[2].append(exact[best])
    join = lambda v, kind: np.concatenate(v).astype(kind) if v else np.zeros(0, kind)
    return join(out[0], np.int64), join(out[1], np.int64), join(out[2], np.float64)


_FOUND = "query_id long, vec_id long, score double"


def _found(result) -> pa.Table:
    return pa.table({"query_id": result[0], "vec_id": result[1], "score": result[2]})


def best_of(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def brute_force(vectors: DataFrame, queries: list[tuple[int, list[float]]], k: int) -> DataFrame:
    """The exact neighbours of a bounded list of queries."""
    qids = np.array([i for i, _ in queries], np.int64)
    q = np.array([v for _, v in queries], np.float64)
    shared = vectors.sparkSession.sparkContext.broadcast((qids, q))  # the caller bounds it

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, q = shared.value
        for b in batches:
            if b.num_rows:
                yield from _found(top(q, qids, matrix(b.column("v")), b.column("id").to_numpy(), k)).to_batches()

    return best_of(vectors.mapInArrow(run, _FOUND), k)


def leaf_count(rows: int) -> int:
    return int(min(4096, max(4, 2 ** round(np.log2(max(1, rows) ** 0.5 / 2)))))


def search(rows: DataFrame, is_query: Column, k: int = 10, recall: float = 0.95, sample: int = 20_000, probes: int = 128, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score, recall: the k nearest found of every row for
    which ``is_query`` (over ``id``) holds, and the share of the true neighbours
    that held-out probes found (null without such probes)."""
    spark = rows.sparkSession
    vectors = scratch.table(valid_vectors(rows, id_col, vector_col), "vectors")
    first = vectors.select(F.size("v")).first()
    if not first:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double, recall double")
    some = first_by_hash(vectors, "id", sample).select("v").toArrow()
    tree = Tree(matrix(some["v"]), leaf_count(vectors.count()))
    shared = spark.sparkContext.broadcast(tree)  # 4096 leaves at most

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shared.value.leaf_of(matrix(b.column("v"))))], ["id", "v", "leaf"])

    indexed = vectors.mapInArrow(assign, "id long, v array<double>, leaf long").withColumn("n", F.monotonically_increasing_id())
    indexed = scratch.table(indexed, "leaves")
    sizes_of = {r["leaf"]: r["count"] for r in indexed.groupBy("leaf").count().collect()}  # a row for each leaf
    queries = indexed.where(is_query)
    probe = [(r["id"], r["v"]) for r in first_by_hash(queries, "id", probes).collect()]
    visits, reached = _calibrate(tree, indexed, probe, k, recall)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, own = matrix(b.column("v")) if b.num_rows else [], b.column("own").to_pylist()
            at, leaf = [], []
            for i in range(b.num_rows):
                rows = 0
                for n, bin_ in enumerate(shared.value.bins(x[i])):
                    if n >= visits and rows >= k + own[i]:  # beyond the calibrated visits only while candidates are short
                        break
                    if bin_ in sizes_of:
                        rows += sizes_of[bin_]
                        at.append(i)
                        leaf.append(bin_)
            taken = b.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([taken.column("id"), taken.column("v"), taken.column("part"), pa.array(leaf, pa.int64())], ["id", "v", "part", "leaf"])

    most = max(1, PART_BYTES // (8 * first[0]))
    parts = lambda n: F.ceil(n / F.lit(most)).cast("int")
    asked = queries.select("id", "v", F.count("*").over(Window.partitionBy("id")).alias("own"), "n")
    asked = asked.withColumn("part", F.pmod(F.xxhash64("n"), parts(F.lit(max(1, queries.count())))).cast("int")).drop("n")
    asked = asked.mapInArrow(visit, "id long, v array<double>, part int, leaf long")
    # a query meets every part of a leaf's rows, and a row every part of the queries
    sizes = F.create_map(*[F.lit(x) for pair in sizes_of.items() for x in pair])  # a number for each leaf
    split = parts(sizes[F.col("leaf")])
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    asked = asked.select("id", "v", "leaf", "part", every(split).alias("with"))
    dealt = indexed.select("id", "v", "leaf", F.pmod(F.xxhash64("n"), split).cast("int").alias("with"), every(parts(F.lit(max(1, queries.count())))).alias("part"))

    def scan(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _found(([], [], [])).cast(pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]))
        return _found(top(matrix(left["v"]), left["id"].to_numpy(), matrix(right["v"]), right["id"].to_numpy(), k))

    found = asked.groupBy("leaf", "part", "with").cogroup(dealt.groupBy("leaf", "part", "with")).applyInArrow(scan, _FOUND)
    return best_of(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", F.lit(reached).cast("double").alias("recall"))


def _calibrate(tree: Tree, indexed: DataFrame, probe: list[tuple[int, list[float]]], k: int, recall: float) -> tuple[int, float | None]:
    """The fewest leaf visits at which the first half of the probes find their
    true neighbours to ``recall``, and the share that the second half then finds."""
    if not probe:
        return tree.leaves, None
    truth = brute_force(indexed.select("id", "v"), probe, k)
    placed = truth.join(indexed.select(F.col("id").alias("vec_id"), "leaf"), "vec_id").select("query_id", "leaf").collect()
    place = {i: {leaf: n for n, leaf in enumerate(tree.order(np.array(v)))} for i, v in probe}
    learn = {i for i, _ in probe[::2]}
    ranks = sorted(place[r["query_id"]][r["leaf"]] for r in placed if r["query_id"] in learn)
    if not ranks:
        return tree.leaves, None
    visits = min(tree.leaves, ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))))] + 1)
    others = [place[r["query_id"]][r["leaf"]] < visits for r in placed if r["query_id"] not in learn]
    return visits, float(np.mean(others)) if others else None
