import math
from datetime import UTC, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.functions import grounding
from tidewater.operators import drift, learning, lineage, retrieval
from tidewater.plans import features, serving
from tidewater.sources.snapshots import SnapshotStore

T0 = datetime(2024, 1, 1, tzinfo=UTC)  # a Monday


def test_split_on_the_nearest_monday(spark):
    rows = [(T0 + timedelta(days=d),) for d in [0] * 5 + [8] * 3 + [15] * 2 + [22] * 2]
    df = spark.createDataFrame(rows, "t timestamp")
    train, test = learning.temporal_split(df, "t", 0.2)
    assert (train.count(), test.count()) == (10, 2)
    with pytest.raises(ValueError):
        learning.split_week(df.limit(2), "t")
    assert learning.split_week(df.where(F.col("t") < F.lit(T0 + timedelta(days=10))), "t", 0.99) == (T0 + timedelta(days=7)).replace(tzinfo=None)


def test_baseline_falls_back(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0), (None, 100.0)], "s string, y double")
    base = learning.segment_baseline(df, "y", "s")
    got = {r["s"]: r["prediction"] for r in learning.predict_baseline(spark.createDataFrame([("a",), ("z",), (None,)], "s string"), base, "s").collect()}
    assert got == {"a": 2.0, "z": 6.5, None: 6.5}


def ap(labels, scores):
    out, found, last = 0.0, 0, None
    order = sorted(set(scores), reverse=True)
    for s in order:
        n = sum(x >= s for x in scores)
        p = sum(y for x, y in zip(scores, labels) if x >= s)
        out += (p - found) * p / n
        found = p
    return out / sum(labels) if sum(labels) else 0.0


def test_average_precision(spark):
    rng = np.random.default_rng(0)
    rows = [(int(rng.random() < 0.3), float(round(rng.random(), 2))) for _ in range(500)]
    df = spark.createDataFrame(rows, "label int, score double")
    assert learning.average_precision(df) == pytest.approx(ap(*zip(*rows)))
    assert learning.average_precision(df.limit(0)) == 0


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(1)
    rows = []
    for k in range(600):
        a, b = rng.normal(), rng.normal()
        rows.append((1, k, T0 + timedelta(hours=k), float(a), float(b) if k % 9 else None, bool(a + 0.3 * rng.normal() > 0.8), k % 2 == 0, float(3 * a + rng.normal())))
    return spark.createDataFrame(rows, "repo_id long, pr_number long, t timestamp, a double, b double, breach boolean, is_bot_author boolean, y double").persist()


def test_training_scoring_and_registry(spark, frame, tmp_path):
    train, test = learning.temporal_split(frame, "t")
    model = learning.train_classifier(train, test, ["a", "b"], trees=5)
    assert model.beats_baseline and model.metrics["average_precision"] > 0.7
    out = learning.predictions(test, model)
    assert out.columns == ["repo_id", "pr_number", "breach_risk", "breach", "is_bot_author"] and out.where("breach_risk not between 0 and 1").count() == 0
    registry = learning.Registry(str(tmp_path / "r.json"))
    assert registry.register("m", model, {"events": 3}) == 1 and registry.register("m", learning.Trained(None, [], {"mae": 2.0, "baseline_mae": 1.0}, "x")) is None
    assert serving.versions(registry, "m")["training_data_delta_versions"] == {"events": 3}
    regression = learning.train_regressor(train, test, ["a"], "y", "is_bot_author", trees=5)
    assert regression.beats_baseline
    with pytest.raises(ValueError):
        learning.train_classifier(train.where("breach"), test, ["a"])


def test_contributions_add_up(frame):
    intercept, weights, means = learning.linear_model(frame, ["a", "b"], "breach")
    got = learning.contributions(frame.select("pr_number", "a", "b"), intercept, weights, means).join(frame.select("pr_number", F.col("a").alias("x"), F.coalesce("b", F.lit(0.0)).alias("z")), "pr_number").limit(20).collect()
    assert all(r["baseline"] + r["a"] + r["b"] == pytest.approx(intercept + weights["a"] * r["x"] + weights["b"] * r["z"]) for r in got)
    assert [x["feature"] for x in learning.ranked({"b": 1.0, "a": -1.0, "c": 2.0})] == ["c", "a", "b"]
    assert learning.direction(0) == "increases_risk" and learning.feature_set_version(["a", "b"]) != learning.feature_set_version(["b", "a"])


def test_similarity_pays_on_the_same_rows(frame):
    similar = frame.where("pr_number % 3 != 0").select("repo_id", "pr_number", F.lit(2).alias("similar_resolved_count"), F.col("breach").cast("double").alias("similar_breach_rate"))
    got = learning.paired_comparison(frame, similar, ["b"], "t")
    assert got["with"] > got["without"]


def test_drift(spark):
    ref = spark.range(1000).select((F.col("id") % 100).cast("double").alias("x"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("c"), F.col("id").alias("n"), F.lit(1).alias("gone"))
    cur = ref.select((F.col("x") * 3 + 100).alias("x"), "c", F.lit(None).cast("long").alias("n"))
    got = {f["column"]: f for f in drift.compare(ref, cur, ["x", "c", "n", "gone"])}
    assert (got["x"]["verdict"], got["c"]["verdict"], got["n"]["verdict"], got["gone"]["verdict"]) == ("major", "stable", "all_null", "missing")
    same = {f["column"]: f["psi"] for f in drift.compare(ref, ref, ["x", "c"])}
    assert same == {"x": 0, "c": 0}
    two = lambda a, b: spark.createDataFrame([("a",)] * a + [("b",)] * b, "c string")
    assert drift.compare(two(5, 5), two(9, 1), ["c"])[0]["psi"] == pytest.approx(0.4 * math.log(1.8) + -0.4 * math.log(0.2))
    assert drift.missing_values({"a": None, "b": math.nan, "c": 0}) == ["a", "b"]
    many = ref.select(F.col("n").cast("string").alias("c"))
    assert drift.compare(many, many, ["c"]) == [{"column": "c", "kind": "none", "verdict": "stable", "psi": 0.0}]
    assert drift.compare(many, many.select(F.concat("c", F.lit("x")).alias("c")), ["c"])[0]["verdict"] == "major"
    nothing = many.where("false")
    assert [f["verdict"] for f in drift.compare(nothing, nothing, ["c"])] == ["stable"]


def test_lineage(spark):
    edges = spark.createDataFrame(
        [(None, "abfss://bronze@s/raw//", "a", "l.silver.e", None, "b"), ("l.silver.e", None, "b", None, "/data/gold/f/", "c"), ("l.silver.e", None, "b", "l.silver.e", None, "b"), (None, None, "x", "l.gold.f", None, "c"), (None, "/tmp/x", "q", "l.gold.f", None, "c")],
        "source_table_full_name string, source_path string, source_column_name string, target_table_full_name string, target_path string, target_column_name string",
    )
    known = spark.createDataFrame([("l.bronze.raw", "abfss://bronze@s/raw"), ("l.gold.f", "/data/gold/f")], "full_name string, storage_path string")
    columns = lineage.column_edges(edges, known)
    got = {(r["source_node"], r["source_tier"], r["target_node"], r["target_tier"]) for r in columns.collect()}
    assert got == {("l.bronze.raw", "bronze", "l.silver.e", "silver"), ("l.silver.e", "silver", "l.gold.f", "gold"), ("/tmp/x", "external", "l.gold.f", "gold")}
    text, page = lineage.artifacts(columns, "today")
    assert '"column_edges": 3' in text and "bronze -->|1 tables, 1 columns| silver" in page and "features" in page


def test_embedding_once_per_text_and_only_new(spark, tmp_path):
    rows = [(f"pr:1:{k}", T0 + timedelta(hours=k), f"h{k % 3}", f"text {k % 3}") for k in range(9)]
    texts = spark.createDataFrame(rows, "entity_key string, event_time timestamp, text_hash string, text string")
    calls = tmp_path / "calls"
    calls.mkdir()

    def load():
        encode = retrieval.hashing_encoder(8)

        def counted(batch):
            import uuid

            for _ in batch:
                (calls / uuid.uuid4().hex).touch()
            return encode(batch)

        return counted

    out = retrieval.embed(texts, load, batch=2, partitions=2).collect()
    assert len(out) == 9 and len(list(calls.iterdir())) == 3
    assert retrieval.pending(texts, texts.limit(4)).count() == 5
    assert len({tuple(r["embedding"]) for r in out}) == 3


def test_texts_need_title_body_and_ids(spark):
    good = '{"type":"PullRequestEvent","created_at":"2024-01-01T00:00:00Z","repo":{"id":5},"payload":{"action":"opened","pull_request":{"number":7,"title":"t","body":"b"}}}'
    rows = [(good,), (good.replace('"body":"b"', '"x":1'),), (good.replace("opened", "closed"),), (good.replace('"number":7,', ""),), ("{",)]
    got = retrieval.extract_texts(spark.createDataFrame(rows, "raw_json string")).collect()
    assert [(r["entity_key"], r["text"]) for r in got] == [("pr:5:7", "t\n\nb")]


def test_neighbours_are_strictly_earlier_and_resolved(spark):
    at = lambda n: T0 + timedelta(hours=n)
    vectors = spark.createDataFrame([(f"pr:1:{k}", at(k), [float(k), 0.0]) for k in range(10)] + [("junk", at(0), [5.0, 0.0])], "entity_key string, event_time timestamp, embedding array<double>")
    spine = spark.createDataFrame([("pr:1:5", at(5), [5.0, 0.0])], "query_key string, as_of timestamp, embedding array<double>")
    got = retrieval.nearest_before(spine, vectors, 3).orderBy("rank").collect()
    assert [r["entity_key"] for r in got] == ["junk", "pr:1:4", "pr:1:3"]
    keys = spark.createDataFrame([(1, 5, at(5)), (1, 6, at(5))], "repo_id long, pr_number long, as_of_timestamp timestamp")
    ends = spark.createDataFrame([(1, 4, at(4.5), True), (1, 3, at(5), False)], "repo_id long, pr_number long, closed_at timestamp, breach boolean")
    rows = {r["pr_number"]: (r["similar_resolved_count"], r["similar_breach_rate"]) for r in retrieval.similarity_features(keys, retrieval.nearest_before(spine, vectors, 3), ends).collect()}
    assert rows == {5: (1, 1.0), 6: (0, None)}
    sample = retrieval.hash_sample(vectors, ["entity_key"], 4)
    assert sample.collect() == retrieval.hash_sample(vectors.repartition(5), ["entity_key"], 4).collect()


RETURNS = [("predict", {"breach_risk": 0.38462, "model_version": "2", "read_delta_versions": {"events": 92}}), ("explain", {"baseline": -1.25, "contributions": [{"feature": "age", "contribution": 0.4}, {"feature": "size", "contribution": -0.2}]})]


@pytest.mark.parametrize(
    ("answer", "good"),
    [
        ("The score is 0.385 and the baseline is -1.25.", True),
        ("The score is 0.384 (38.5%).", True),
        ("The score is 0.4.", False),
        ("The score is 0.38.", True),
        ("It was trained on version 92.", False),
        ("Reading version 92 the model is version 2.", True),
        ("The model is version 92.", False),
        ("age raises the risk. size lowers it.", True),
        ("age lowers the risk.", False),
        ("age raises and lowers it.", True),
        ('At 2024-01-01T10:00:00Z the "q_17" was seen.', True),
        ("There are 7 of them.", False),
        ("No numbers.", True),
    ],
)
def test_grounding(answer, good, tmp_path):
    verdict = grounding.write_trace(answer, RETURNS, tmp_path / "t.json")
    assert verdict.grounded == good, verdict.failures
    assert (tmp_path / "t.json").exists()


def test_tools_answer_or_refuse(spark, tmp_path):
    schema = "event_id string, repo_id long, pr_number long, created_at timestamp, event_type string, event_action string, actor_login string, pr_merged boolean, pr_draft boolean"
    at = lambda n: T0 + timedelta(hours=n)
    rows = [("a", 1, 1, at(0), "PullRequestEvent", "opened", "ann", None, False), ("b", 1, 1, at(1), "PullRequestEvent", "closed", "ann", True, None), ("c", 1, 2, at(2), "PullRequestEvent", "opened", "ann", None, True), ("d", 1, 3, at(9), "PullRequestEvent", "opened", "ann", None, False)]
    events, store = spark.createDataFrame(rows, schema), SnapshotStore(spark, str(tmp_path / "f"))
    features.build_features(store, events)
    tools = serving.Tools(spark, events, store)
    known = tools.get_features(serving.Request(1, 2, at(5)))
    assert known["features"]["events_total_to_date"] == 3 and known["features"]["is_draft"] is True and known["features"]["prior_pr_count"] == 1
    assert tools.get_features(serving.Request(1, 3, at(5)))["reason"] == "not_open"
    assert tools.predict(serving.Request(1, 2, at(5)), lambda f: 0.25, 4)["breach_risk"] == 0.25
    assert tools.predict(serving.Request(1, 2, at(5)), lambda f: 25, 4)["reason"] == "score_out_of_range"
    assert tools.predict(serving.Request(1, 1, at(0.5)), lambda f: 0.1, 4)["missing"] == ["prior_merge_rate"]
    assert [c["feature"] for c in tools.explain(serving.Request(1, 2, at(5)), lambda f: ({"x": 1.0, "y": -3.0}, 0.5), 4)["contributions"]] == ["y", "x"]
    with pytest.raises(ValueError):
        serving.Request(1, 2, datetime(2024, 1, 1))
    gate = serving.Gateway({"get": lambda **k: {"ok": 1}, "drop": lambda **k: {}}, {"get"}, tmp_path / "audit.jsonl")
    assert gate.call("get", a=1) == {"ok": 1} and gate.call("drop")["reason"] == "not_allowed"
    assert [r["outcome"] for r in gate.records()] == ["ok", "denied"]
    assert features.moved({"a": 1, "b": 2}, {"a": 1, "b": 3}) == ["b"]
    assert serving.parse_versions('[{"name": "a", "version": "3"}]') == {"a": 3}
    for bad in ('[{"name": "a"', '[{"name": "a", "version": 1}, {"name": "a", "version": 2}]'):
        with pytest.raises(ValueError):
            serving.parse_versions(bad)
