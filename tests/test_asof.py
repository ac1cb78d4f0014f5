from datetime import UTC, datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.operators.asof import as_of_join, rolling, running

DAY = datetime(2024, 1, 1, tzinfo=UTC)


def day(n):
    return DAY + timedelta(days=n)


def spine(spark, rows):
    return spark.createDataFrame(rows, "repo_id long, as_of timestamp")


def log(spark, rows):
    return spark.createDataFrame(rows, "repo_id long, t timestamp, value long")


def join(spark, s, f):
    return as_of_join(spine(spark, s), log(spark, f), ["repo_id"], "as_of", "t")


def test_last_row_strictly_before_wins(spark):
    got = join(spark, [(1, day(13)), (1, day(12)), (1, day(10)), (2, day(13))], [(1, day(10), 1), (1, day(12), 2), (1, day(14), 99)]).select("repo_id", F.dayofmonth("as_of").alias("d"), "value").collect()
    assert {(r["repo_id"], r["d"], r["value"]) for r in got} == {(1, 14, 2), (1, 13, 1), (1, 11, None), (2, 14, None)}


def test_hot_key_keeps_every_row(spark):
    got = join(spark, [(1, day(k)) for k in (2, 4, 6, 8)], [(1, day(k), 10 * k) for k in (1, 3, 5, 7)])
    assert sorted(r["value"] for r in got.collect()) == [10, 30, 50, 70]


def test_null_value_of_the_last_row_is_kept(spark):
    got = join(spark, [(1, day(9))], [(1, day(1), 5), (1, day(2), None)]).collect()
    assert got[0]["value"] is None


def test_null_keys_and_times_survive_unmatched(spark):
    got = join(spark, [(None, day(9)), (1, None), (1, day(9)), (1, day(9))], [(None, day(1), 5), (1, day(1), 7), (1, None, 8)]).collect()
    assert len(got) == 4 and sorted((r["value"] is None, r["repo_id"]) for r in got if r["repo_id"]) == [(False, 1), (False, 1), (True, 1)]
    assert next(r for r in got if r["repo_id"] is None)["value"] is None


def test_equal_instants_take_the_last_by_tiebreak(spark):
    assert {r["value"] for r in join(spark, [(1, day(9))], [(1, day(1), 3), (1, day(1), 8), (1, day(1), 5)]).collect()} == {8}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 6)), max_size=12), st.lists(st.tuples(st.integers(0, 2), st.integers(0, 6)), max_size=12))
def test_equals_brute_force(spark, s, f):
    rows = [(k, day(t), i) for i, (k, t) in enumerate(f)]
    got = join(spark, [(k, day(t)) for k, t in s], rows).select("repo_id", F.datediff("as_of", F.lit("2024-01-01")).alias("d"), "value").collect()
    want = []
    for k, t in s:
        before = [(x, i) for i, (j, x) in enumerate(f) if j == k and x < t]
        want.append((k, t, max(before)[1] if before else None))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_one_exchange_per_side_key(spark):
    plan = join(spark, [(1, day(1))], [(1, day(0), 1)])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_running_sums_settle_ties(spark):
    rows = log(spark, [(1, day(1), 1), (1, day(1), 1), (1, day(2), 5)])
    got = running(rows, ["repo_id"], "t", n=F.lit(1), v=F.col("value")).orderBy("t").collect()
    assert [(r["n"], r["v"]) for r in got] == [(2, 2), (3, 7)]


@pytest.fixture
def events(spark):
    def make(*minutes):
        return spark.createDataFrame([(str(k), 1, DAY + timedelta(minutes=m)) for k, m in enumerate(minutes)], "event_id string, repo_id long, created_at timestamp")

    return make


def test_rolling_counts(events):
    got = rolling(events(0, 10, 20, 30), "repo_id").orderBy("event_time").collect()
    assert [r["events_prior_1h"] for r in got] == [None, 1, 2, 3]
    assert got[0]["secs_since_last_event"] is None and got[3]["secs_since_last_event"] == 600


def test_rolling_windows_end(events):
    got = rolling(events(0, 120), "repo_id").orderBy("event_time").collect()[1]
    assert (got["events_prior_1h"], got["events_prior_24h"], got["secs_since_last_event"]) == (0, 1, 7200)


def test_rolling_ties_see_the_same_past(events):
    got = rolling(events(0, 0, 30, 30), "repo_id").orderBy("event_time").collect()
    assert [r["events_prior_1h"] for r in got] == [None, None, 2, 2]
