"""Labels, splits, baselines, training, scoring and explanations."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ranks import counted, quantiles

PR = ["repo_id", "pr_number"]


def breach_labels(fact: DataFrame, threshold_seconds: int) -> DataFrame:
    """repo_id, pr_number, breach: whether the first response took longer than the
    threshold, or never came before the end.  Other exclusions have no label."""
    late = F.when(F.col("label_exclusion").isNull(), F.col("time_to_first_response_seconds") > threshold_seconds).when(F.col("label_exclusion") == "closed_no_response", F.lit(True))
    return fact.select(*PR, late.alias("breach")).where("breach is not null")


def join_label(frame: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows that have a response time."""
    return frame.join(fact.where("time_to_first_response_seconds is not null").select(*PR, "time_to_first_response_seconds"), PR)


def join_breach(frame: DataFrame, fact: DataFrame, threshold_seconds: int) -> DataFrame:
    return frame.join(breach_labels(fact, threshold_seconds), PR)


def join_similarity(frame: DataFrame, similar: DataFrame) -> DataFrame:
    return frame.join(similar.select(*PR, "similar_resolved_count", "similar_breach_rate"), PR, "left")


def split_week(frame: DataFrame, time: str, test_share: float = 0.2):
    """The Monday at which the test part begins: the week boundary whose share of
    rows after it is nearest to ``test_share`` (ties: the earlier).  The first
    week never is a boundary; fewer than two weeks are an error."""
    weeks = frame.where(F.col(time).isNotNull()).groupBy(F.date_trunc("week", time).alias("week")).agg(F.count("*").alias("n"))
    after = F.sum("n").over(Window.orderBy(F.desc("week")))  # a row a week
    counted = weeks.select("week", (after / F.sum("n").over(Window.partitionBy())).alias("share"))
    rows = counted.orderBy("week").collect()
    if len(rows) < 2:
        raise ValueError("a split by weeks needs two weeks at least")
    return min(rows[1:], key=lambda r: (abs(r["share"] - test_share), r["week"]))["week"]


def temporal_split(frame: DataFrame, time: str, test_share: float = 0.2) -> tuple[DataFrame, DataFrame]:
    at = split_week(frame, time, test_share)
    return frame.where(F.col(time) < F.lit(at)), frame.where(F.col(time) >= F.lit(at))


def segment_baseline(train: DataFrame, label: str, segment: str, how: str = "median") -> DataFrame:
    """segment, prediction, and one row of a null segment for all others.  Medians
    are exact, from counts of distinct labels."""
    kind = train.schema[segment].dataType
    rows = train.select(F.col(segment).alias("segment"), F.col(label).cast("double").alias("y"))
    if how == "median":
        middle = {"prediction": 0.5}
        each = quantiles(rows.where("segment is not null"), "y", middle, ["segment"], interpolate=True)
        overall = quantiles(rows, "y", middle, [], interpolate=True)
    else:
        each = rows.where("segment is not null").groupBy("segment").agg(F.avg("y").alias("prediction"))
        overall = rows.agg(F.avg("y").alias("prediction"))
    return each.select(F.col("segment").alias(segment), "prediction").unionByName(overall.select(F.lit(None).cast(kind).alias(segment), "prediction"))


def predict_baseline(frame: DataFrame, baseline: DataFrame, segment: str) -> DataFrame:
    overall = baseline.where(F.col(segment).isNull()).select(F.col("prediction").alias("__all"))
    known = baseline.where(F.col(segment).isNotNull())
    out = frame.join(known, segment, "left").crossJoin(F.broadcast(overall))  # one row
    return out.withColumn("prediction", F.coalesce("prediction", "__all")).drop("__all")


def average_precision(scored: DataFrame, label: str = "label", score: str = "score") -> float:
    """Sum of precision times gain in recall over the distinct scores, from high to
    low; counts of scores are summed in ranges, so no task sorts all rows."""
    rows = counted(scored.select((-F.col(score).cast("double")).alias("s"), F.col(label).cast("long").alias("y")), "s", [], p=F.col("y"))
    found, seen = F.col("p_start") + F.col("p"), F.col("start") + F.col("n")
    one = rows.agg(F.sum(F.col("p") * found / seen).alias("a"), F.sum("p").alias("p")).first()
    return float(one["a"] / one["p"]) if one["p"] else 0.0


def _assembled(frame: DataFrame, features: list[str]) -> DataFrame:
    """Nulls become -1 next to a flag each, so that unknown differs from zero."""
    filled = frame.select("*", *[F.coalesce(F.col(c).cast("double"), F.lit(-1.0)).alias(f"__f_{c}") for c in features], *[F.col(c).isNull().cast("double").alias(f"__n_{c}") for c in features])
    names = [f"__f_{c}" for c in features] + [f"__n_{c}" for c in features]
    return VectorAssembler(inputCols=names, outputCol="__x").transform(filled).drop(*names)


@dataclass
class Trained:
    model: object
    features: list[str]
    metrics: dict[str, float]
    candidate: str

    @property
    def beats_baseline(self) -> bool:
        m = self.metrics
        return m["mae"] < m["baseline_mae"] if "mae" in m else m["average_precision"] > m["baseline_average_precision"]


def train_classifier(train: DataFrame, test: DataFrame, features: list[str], label: str = "breach", candidates: tuple[str, ...] = ("default", "balanced"), trees: int = 20, depth: int = 4) -> Trained:
    """Gradient-boosted trees, plain or with classes weighed alike; the candidate of
    the best average precision on ``test``.  The baseline ranks by no feature."""
    one = train.agg(F.avg(F.col(label).cast("double")).alias("share")).first()["share"]
    if one is None or one in (0.0, 1.0):
        raise ValueError("training rows need both classes")
    best = None
    for name in candidates:
        weight = F.when(F.col(label), F.lit(0.5 / one)).otherwise(F.lit(0.5 / (1 - one))) if name == "balanced" else F.lit(1.0)
        rows = _assembled(train.withColumn("__w", weight).withColumn("__y", F.col(label).cast("double")), features)
        model = GBTClassifier(featuresCol="__x", labelCol="__y", weightCol="__w", maxIter=trees, maxDepth=depth, seed=1).fit(rows)
        found = Trained(model, features, {}, name)
        ap = average_precision(score(test, found).withColumn("__y", F.col(label).cast("int")), "__y")
        found.metrics = {"average_precision": ap, "baseline_average_precision": float(test.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0)}
        if best is None or ap > best.metrics["average_precision"]:
            best = found
    return best


def train_regressor(train: DataFrame, test: DataFrame, features: list[str], label: str, segment: str, trees: int = 20) -> Trained:
    rows = _assembled(train.withColumn("__y", F.col(label).cast("double")), features)
    model = GBTRegressor(featuresCol="__x", labelCol="__y", maxIter=trees, maxDepth=4, seed=1).fit(rows)
    mae = lambda d: float(d.agg(F.avg(F.abs(F.col("prediction") - F.col(label)))).first()[0])
    own = mae(model.transform(_assembled(test, features)))
    return Trained(model, features, {"mae": own, "baseline_mae": mae(predict_baseline(test, segment_baseline(train, label, segment), segment))}, "default")


def score(frame: DataFrame, trained: Trained) -> DataFrame:
    """``frame`` with ``score``, the probability of the positive class."""
    out = trained.model.transform(_assembled(frame, trained.features))
    return out.select(*frame.columns, vector_to_array("probability")[1].alias("score"))


def predictions(frame: DataFrame, trained: Trained) -> DataFrame:
    """repo_id, pr_number, breach_risk, breach, is_bot_author."""
    return score(frame, trained).select(*PR, F.col("score").alias("breach_risk"), "breach", "is_bot_author")


def linear_model(train: DataFrame, features: list[str], label: str) -> tuple[float, dict[str, float], dict[str, float]]:
    """Intercept, weights and means of a logistic model, whose contributions add up."""
    rows = train.select(F.col(label).cast("double").alias("__y"), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])
    model = LogisticRegression(featuresCol="__x", labelCol="__y", regParam=1e-3).fit(VectorAssembler(inputCols=features, outputCol="__x").transform(rows))
    means = rows.agg(*[F.avg(c).alias(c) for c in features]).first().asDict()
    return float(model.intercept), dict(zip(features, map(float, model.coefficients))), means


def contributions(frame: DataFrame, intercept: float, weights: dict[str, float], means: dict[str, float]) -> DataFrame:
    """One column a feature with its part of the raw score against the mean, and
    ``baseline``; they add up to the raw score."""
    base = intercept + sum(w * means[c] for c, w in weights.items())
    return frame.select(*[c for c in frame.columns if c not in weights], *[(F.lit(w) * (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.lit(means[c]))).alias(c) for c, w in weights.items()], F.lit(base).alias("baseline"))


def ranked(values: dict[str, float]) -> list[dict]:
    """Contributions by size, then name, with the way they push (0 raises)."""
    return [{"feature": k, "contribution": v, "direction": direction(v)} for k, v in sorted(values.items(), key=lambda x: (-abs(x[1]), x[0]))]


def ranked_rows(frame: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """keys, rank, feature, contribution, direction: the contributions of every row by
    size, then name.  Null contributions are left out."""
    each = F.filter(F.array(*[F.struct((-F.abs(F.col(c))).alias("o"), F.lit(c).alias("feature"), F.col(c).cast("double").alias("contribution")) for c in features]), lambda x: x["contribution"].isNotNull())
    rows = frame.select(*keys, F.posexplode(F.array_sort(each)).alias("n", "x"))
    way = F.when(F.col("x.contribution") >= 0, "increases_risk").otherwise("decreases_risk")
    return rows.select(*keys, (F.col("n") + 1).alias("rank"), "x.feature", "x.contribution", way.alias("direction"))


@dataclass(frozen=True)
class TreeTable:
    """Trees as arrays: of each node its feature (-1: leaf), threshold, children and
    value (times the tree's weight); ``roots`` are the trees' first nodes."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray

    @classmethod
    def of(cls, model) -> TreeTable:
        """From a fitted ensemble.  Splits on numbers only, as training makes them."""
        rows: list[list[float]] = []

        def add(node, weight: float) -> int:
            at = len(rows)
            rows.append([-1, 0.0, -1, -1, weight * node.prediction()])
            if node.subtreeDepth() > 0:
                split = node.split()
                rows[at][:2] = [split.featureIndex(), split.threshold()]
                rows[at][2] = add(node.leftChild(), weight)
                rows[at][3] = add(node.rightChild(), weight)
            return at

        roots = [add(tree._java_obj.rootNode(), w) for tree, w in zip(model.trees, model.treeWeights)]
        table = np.array(rows, np.float64).reshape(-1, 5)
        whole = lambda k: table[:, k].astype(np.int64)
        return cls(whole(0), table[:, 1], whole(2), whole(3), table[:, 4], np.array(roots, np.int64))

    def contributions(self, x: np.ndarray) -> np.ndarray:
        """(rows, features + 1): on its way down a tree a row's value moves from node
        to node, and each step is credited to the feature that was asked; the last
        column is what all rows start from.  A row adds up to its raw score."""
        out = np.zeros((len(x), x.shape[1] + 1))
        out[:, -1] = self.value[self.roots].sum()
        every = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            while len(going := every[self.feature[at] >= 0]):
                node = at[going]
                asked = self.feature[node]
                to = np.where(x[going, asked] <= self.threshold[node], self.left[node], self.right[node])
                out[going, asked] += self.value[to] - self.value[node]
                at[going] = to
        return out


def tree_contributions(frame: DataFrame, trained: Trained, keys: list[str]) -> DataFrame:
    """keys, a column for each feature, ``baseline`` and ``raw``: what each feature
    contributes to the raw score of the model that scores.  A feature and its flag
    for an unknown value count together."""
    table, features = TreeTable.of(trained.model), trained.features
    shared = frame.sparkSession.sparkContext.broadcast(table)  # a few thousand nodes
    rows = _assembled(frame, features).select(*[F.col(c) for c in keys], vector_to_array("__x").alias("__x"))
    out = T.StructType([*rows.select(*keys).schema.fields, *[T.StructField(c, T.DoubleType()) for c in [*features, "baseline", "raw"]]])
    n = len(features)

    def run(batches):
        for b in batches:
            if b.num_rows:
                x = np.asarray(b.column("__x").flatten()).reshape(b.num_rows, -1)
                parts = shared.value.contributions(x)
                own = parts[:, :n] + parts[:, n : 2 * n]
                columns = [*own.T, parts[:, -1], parts.sum(axis=1)]
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keys], *[pa.array(c) for c in columns]], out.names)

    return rows.mapInArrow(run, out)


def direction(value: float) -> str:
    return "increases_risk" if value >= 0 else "decreases_risk"


def feature_set_version(columns: list[str]) -> str:
    """12 hex digits that change with names and their order."""
    return hashlib.sha256(json.dumps(columns).encode()).hexdigest()[:12]


class Registry:
    """Champions by name in a JSON file of the driver."""

    def __init__(self, path: str) -> None:
        self.path = path

    def _all(self) -> dict:
        try:
            with open(self.path) as f:
                return json.load(f)
        except FileNotFoundError:
            return {}

    def register(self, name: str, trained: Trained, inputs: dict[str, int] | None = None) -> int | None:
        """The new version, or None if the model does not beat its baseline."""
        if not trained.beats_baseline:
            return None
        everything = self._all()
        versions = everything.setdefault(name, [])
        versions.append({"version": len(versions) + 1, "features": trained.features, "feature_set_version": feature_set_version(trained.features), "metrics": trained.metrics, "inputs": inputs or {}})
        with open(self.path, "w") as f:
            json.dump(everything, f, indent=1)
        return len(versions)

    def champion(self, name: str) -> dict:
        versions = self._all().get(name)
        if not versions:
            raise LookupError(f"no champion {name}")
        return versions[-1]


def paired_comparison(plain: DataFrame, similar: DataFrame, features: list[str], time: str, label: str = "breach") -> dict[str, float]:
    """Average precision without and with the similarity features, on the same rows."""
    both = join_similarity(plain, similar).where("similar_breach_rate is not null")
    train, test = temporal_split(both, time)
    without = train_classifier(train, test, features, label, ("default",))
    more = train_classifier(train, test, [*features, "similar_resolved_count", "similar_breach_rate"], label, ("default",))
    return {"without": without.metrics["average_precision"], "with": more.metrics["average_precision"]}


def risk_column(score_: Column, threshold: float = 0.5) -> Column:
    return score_ >= threshold
