"""Labelled documents, all or bounded samples, and scores turned to probabilities."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def first_by_hash(rows: DataFrame, id_col: str, n: int) -> DataFrame:
    """``n`` rows of least hash of the id (all, if there are fewer), the same on
    every run.  Rows that cannot be among them are left out before the sort, so
    that the sort gets about twice ``n`` rows however large the table is."""
    total = rows.count()
    hashed = F.xxhash64(id_col)
    if total > 4 * n:
        rows = rows.where(hashed < F.lit(int(-(2**63) + 2**64 * (2 * n / total))))
    return rows.orderBy(hashed, id_col).limit(n)


def usable(labels: DataFrame, label: str, learn_from: Column) -> DataFrame:
    """doc_id and label (0/1), one row an id, of what passes ``learn_from`` (over doc_id)."""
    return (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & learn_from)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )


def training_sample(docs: DataFrame, labels: DataFrame, label: str, learn_from: Column, rows: int, more: list[str] | None = None) -> DataFrame:
    """doc_id, text, label (0/1) and the columns ``more`` of at most ``rows`` labelled documents.

    The ids are the first in a hash order among ``labels`` that pass
    ``learn_from`` (over doc_id) and have a label, so the sample is the same on
    every run.  The chosen ids, ``rows`` at most, are broadcast to one scan.
    """
    chosen = first_by_hash(usable(labels, label, learn_from), "doc_id", rows)
    found = docs.select("doc_id", "text", *(more or [])).where(F.col("text").isNotNull())
    return found.join(F.broadcast(chosen), "doc_id")


def all_labelled(docs: DataFrame, labels: DataFrame, label: str, learn_from: Column, more: list[str] | None = None, broadcast: int = 2_000_000) -> tuple[DataFrame, int]:
    """doc_id, text, label (0/1) and the columns ``more`` of every labelled
    document, and the number of labelled ids.  Up to ``broadcast`` ids are
    broadcast to one scan; more are joined in the way that Spark chooses."""
    chosen = usable(labels, label, learn_from)
    n = chosen.count()
    found = docs.select("doc_id", "text", *(more or [])).where(F.col("text").isNotNull())
    return found.join(F.broadcast(chosen) if n <= broadcast else chosen, "doc_id"), n


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def platt(raw: np.ndarray, label: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and intercept that turn raw scores into probabilities (Newton's
    method with smoothed targets).  One class alone keeps slope 1."""
    pos, neg = float(label.sum()), float(len(label) - label.sum())
    if not pos or not neg:
        return 1.0, 0.0
    want = np.where(label > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = sigmoid(a * raw + b)
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - want) * raw).sum() + 1e-3 * (a - 1), (p - want).sum()])
        h = np.array([[(w * raw * raw).sum() + 1e-3, (w * raw).sum()], [(w * raw).sum(), w.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        size = np.abs(step).max()
        a, b = a - step[0] * min(1, 2 / max(size, 1e-12)), b - step[1] * min(1, 2 / max(size, 1e-12))
        if size < 1e-8:
            break
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


def best_threshold(score: np.ndarray, label: np.ndarray, default: float = 0.3, least: int = 30) -> float:
    """The threshold of the best F1, half way to the next lower score; the
    default where one class has fewer than ``least // 3`` rows or there are few rows."""
    pos = int(label.sum())
    if len(label) < least or pos < least // 3 or pos == len(label):
        return default
    order = np.argsort(-score, kind="stable")
    s, hit = score[order], np.cumsum(label[order])
    f1 = 2 * hit / (np.arange(1, len(s) + 1) + pos)
    last = np.append(s[:-1] > s[1:], True)  # ties stay on one side
    k = int(np.argmax(np.where(last, f1, -1)))
    low = s[k + 1] if k + 1 < len(s) else 0.0
    return float((s[k] + low) / 2)
