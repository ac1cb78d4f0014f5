import random
from datetime import UTC, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators import ranks, retrieval
from tidewater.operators.asof import as_of_join
from tidewater.plans import reports

T0 = datetime(2024, 1, 1, tzinfo=UTC)


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(1)
    pool = [0.0, -0.0, 1e-300, -5.0, 7.25, 1e18, *[rng.uniform(-3, 3) for _ in range(60)], *[rng.expovariate(1e-4) for _ in range(60)]]
    rows = [(rng.choice(["a", "b", None]), rng.choice(pool) if rng.random() < 0.95 else None, rng.randrange(5), k) for k in range(1500)]
    return spark.createDataFrame(rows, "g string, v double, r long, k long").persist(), rows


def test_ranges_ascend_with_values(spark):
    rng = random.Random(2)
    values = sorted({*[rng.uniform(-1, 1) * 10.0 ** rng.randrange(-320, 308) for _ in range(3000)], *[s * 2.0**e * (1 + d) for s in (1, -1) for e in range(-40, 40, 7) for d in (-2e-16, 0, 2e-16)], 0.0})
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").coalesce(1).select(ranks.range_of(F.col("v"))).collect()]
    assert got == sorted(got)


def test_counts_and_quantiles(numbers):
    df, rows = numbers
    for r in ranks.counted(df, "v", ["g"], s=F.col("k")).collect():
        own = [x for x in rows if x[0] == r["g"] and x[1] is not None]
        assert r["total"] == len(own) and r["n"] == sum(x[1] == r["v"] for x in own) and r["start"] == sum(x[1] < r["v"] for x in own)
        assert r["s"] == sum(x[3] for x in own if x[1] == r["v"]) and r["s_start"] == sum(x[3] for x in own if x[1] < r["v"])
    at = {"low": 0.1, "mid": 0.5, "high": 0.99}
    for interpolate in (False, True):
        for r in ranks.quantiles(df, "v", at, ["g"], interpolate).collect():
            own = np.array([x[1] for x in rows if x[0] == r["g"] and x[1] is not None])
            for name, p in at.items():
                want = np.quantile(own, p, method="linear" if interpolate else "inverted_cdf")
                assert r[name] == pytest.approx(want, rel=1e-12)


@pytest.mark.parametrize("ties", [10**6, 20])
def test_ntile_equals_the_window(numbers, monkeypatch, ties):
    monkeypatch.setattr(ranks, "TIES", ties)
    df = numbers[0].where("v is not null")
    for groups in (10, 41):
        want = df.withColumn("t", F.ntile(groups).over(Window.orderBy("v", "r", "k")).cast("long"))
        assert ranks.ntile(df, groups, ["v", "r", "k"], "t").exceptAll(want).count() == 0
    assert ranks.ntile(df.limit(0), 10, ["v", "r", "k"], "t").count() == 0


def test_no_task_sorts_all_scores(spark):
    df = spark.range(1000).select((F.col("id") / 1000).alias("v"))
    plan = ranks.counted(df, "v", [])._jdf.queryExecution().executedPlan().toString()
    inside = [x for x in plan.splitlines() if "Window" in x and "__range" in x and "v#" in x]
    assert inside and all("[__range" in x for x in inside)


def test_sliced_as_of_join_equals_the_plain_one(spark):
    rng = random.Random(3)
    at = lambda: T0 + timedelta(minutes=rng.randrange(3000))
    spine = spark.createDataFrame([(k, rng.choice(["hot", "hot", "b", None]), at() if rng.random() < 0.97 else None) for k in range(400)], "n long, key string, t timestamp")
    log = spark.createDataFrame([(rng.choice(["hot", "hot", "b", "c"]), at(), rng.choice([None, 1, 2]), k) for k in range(300)], "key string, at timestamp, x int, y long")
    plain = as_of_join(spine, log, ["key"], "t", "at", ["y"])
    for seconds in (600, 86_400, 10**9):
        sliced = as_of_join(spine, log, ["key"], "t", "at", ["y"], slice_seconds=seconds)
        assert sliced.exceptAll(plain).count() == 0 and sliced.count() == 400


def test_busiest_equals_all_pairs(spark):
    rng = random.Random(4)
    at = lambda: T0 + timedelta(minutes=rng.randrange(6000))
    opens = [(rng.randrange(3), k, at()) for k in range(60)] + [(None, 1, at()), (1, 99, None)]
    events = [(rng.randrange(4), at()) for _ in range(900)] + [(0, t) for _, _, t in opens[:20]] + [(None, T0), (1, None)]
    counts = {}
    for r, p, t in opens:
        if t is not None:
            counts[(r, p)] = sum(x == r and s is not None and t < s < t + timedelta(hours=24) for x, s in events if x is not None)
    best = min(counts, key=lambda k: (-counts[k], k[0] if k[0] is not None else -1, k[1]))
    o, e = spark.createDataFrame(opens, "repo_id long, pr_number long, opened_at timestamp"), spark.createDataFrame(events, "repo_id long, created_at timestamp")
    assert [tuple(r) for r in reports.busiest_after_open(o, e).collect()] == [(*best, counts[best])]
    assert reports.busiest_after_open(o, e.limit(0)).count() == 0
    plan = reports.busiest_after_open(o, e)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner, ((repo_id" in plan and ">" not in plan.split("Join Inner")[1].split("\n")[0].split(":")[0]


def test_neighbours_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 4, (300, 3)).astype(float)  # many ties
    v = spark.createDataFrame([(int(i), T0 + timedelta(seconds=int(i)), row.tolist()) for i, row in enumerate(x)] + [(900, T0, None), (901, T0, [1.0]), (902, None, [1.0, 1.0, 1.0])], "entity_key long, event_time timestamp, embedding array<double>")
    q = v.where("entity_key % 10 = 0 and entity_key < 300").select(F.col("entity_key").alias("query_key"), (F.col("event_time") + F.expr("interval 60 seconds")).alias("as_of"), "embedding")
    monkeypatch.setattr(retrieval, "BLOCK", 37)
    monkeypatch.setattr(retrieval, "ASKED", 7)
    got = {}
    for r in retrieval.nearest_before(q, v, 4).orderBy("rank").collect():
        got.setdefault(r["query_key"], []).append(r["entity_key"])
    for k in range(0, 300, 10):
        known = [i for i in range(300) if i != k and i < k + 60]
        assert got[k] == sorted(known, key=lambda i: (((x[i] - x[k]) ** 2).sum() ** 0.5, i))[:4]


def test_every_nth(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("a"), "id")
    rows = sorted((r["a"], r["id"]) for r in df.collect())
    assert sorted((r["a"], r["id"]) for r in retrieval.every_nth(df, 9, ["a", "id"], 2).collect()) == rows[2::9]
