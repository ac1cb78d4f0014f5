import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tidewater import cli
from tidewater.plans import gold, showcase
from tidewater.settings import Settings
from tidewater.streaming import replay


def event(i):
    return {"id": str(i), "type": "PullRequestEvent", "created_at": f"2025-11-03T{i % 24:02d}:00:00Z", "actor": {"login": f"u{i % 3}"}, "repo": {"id": i % 4, "name": "o/n"}, "payload": {"action": "opened", "pull_request": {"number": i}}}


def test_ingest_features_publish(spark, tmp_path, capsys):
    replay.replay([event(k) for k in range(30)], tmp_path / "landing", cycles=2)
    paths = {k: f"file://{tmp_path}/{k}" for k in ("landing", "silver", "checkpoint", "store")}
    assert cli.main(["ingest", "--landing", paths["landing"], "--silver", paths["silver"], "--checkpoint", paths["checkpoint"]]) == 0
    assert cli.main(["features", "--silver", paths["silver"], "--store", paths["store"]]) == 0
    assert cli.main(["publish", "--store", paths["store"], "--source", "repo_stream", "--target", "online", "--key", "repo_id"]) == 0
    assert cli.main(["publish", "--store", paths["store"], "--source", "nothing", "--target", "online", "--key", "repo_id"]) == 1
    assert "nothing has no version" in capsys.readouterr().err


def test_query_stage(spark, tmp_path):
    assert cli.main(["query", "duplicate_stats", "--tables", "/root/testdata/sf0.001", "--out", str(tmp_path / "o")]) == 0
    assert spark.read.parquet(str(tmp_path / "o")).count() == 1


def test_artifacts(spark, tmp_path):
    raw = [json.dumps(event(k)) for k in range(5)] + ["{broken"]
    bronze = spark.createDataFrame([(x, datetime(2026, 1, 1, tzinfo=UTC), "d", 0) for x in raw], "raw_json string, ingested_at timestamp, event_date string, event_hour int")
    got = showcase.medallion({"new": bronze}, tmp_path / "medallion.json")
    assert (got["new"]["bronze"], got["new"]["silver"], got["new"]["quarantined"]) == (6, 5, 1) and got["new"]["rules"]["repo_id_present"] == 1
    scores = spark.range(9).select(F.lit(1).alias("repo_id"), F.col("id").alias("pr_number"), (F.col("id") % 3 / 10).alias("breach_risk"))
    assert showcase.coverage(scores.withColumn("x", F.when(F.col("pr_number") < 3, 1)), ["x"], tmp_path / "coverage.json")["x"] == 3 / 9
    showcase.queue_artifact(scores, str(tmp_path / "queue"), top=4)
    _, known, queue = showcase.load(spark, str(tmp_path))
    assert known["x"] == 3 / 9 and [r["pr_number"] for r in queue.orderBy("rank").collect()] == [2, 5, 8, 1]


def test_orphans(spark):
    fact = spark.createDataFrame([(1,), (2,), (2,), (None,)], "repo_id long")
    assert [r[0] for r in gold.orphans(fact, spark.createDataFrame([(1,)], "repo_id long"), "repo_id").collect()] == [2]


def test_settings():
    found = Settings.load({"TIDEWATER_STORE": "/s", "TIDEWATER_LATE_MINUTES": "5", "HOME": "x"})
    assert (found.store, found.late_minutes, found.tables) == ("/s", 5, Settings().tables)
    for bad in ({"TIDEWATER_LATE_MINUTES": "soon"}, {"TIDEWATER_STOER": "/s"}):
        with pytest.raises(ValueError):
            Settings.load(bad)
    assert cli.parser(found).parse_args(["features", "--silver", "x"]).store == "/s"
