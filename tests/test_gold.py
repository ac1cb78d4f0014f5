from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewater.plans import features, gold, reports
from tidewater.operators import learning

T0 = datetime(2024, 3, 4, tzinfo=UTC)
SCHEMA = "event_id string, repo_id long, pr_number long, created_at timestamp, event_type string, event_action string, actor_login string, pr_merged boolean, pr_draft boolean, is_pr_comment boolean, ingested_at timestamp"
PR, REVIEW, COMMENT = "PullRequestEvent", "PullRequestReviewEvent", "IssueCommentEvent"


def h(n):
    return T0 + timedelta(hours=n)


def make(spark, *rows):
    full = [(str(k), 1, number, h(at) if at is not None else None, kind, action, actor, merged, draft, flag, h((at or 0) + 1)) for k, (number, at, kind, action, actor, merged, draft, flag) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def opened(number, at, actor="ann", draft=False):
    return (number, at, PR, "opened", actor, None, draft, None)


def closed(number, at, merged=True, action="closed"):
    return (number, at, PR, action, "ann", merged, None, None)


def review(number, at, actor):
    return (number, at, REVIEW, "created", actor, None, None, None)


def comment(number, at, actor, flag=True):
    return (number, at, COMMENT, "created", actor, None, None, flag)


def fact(spark, *rows, **options):
    return {r["pr_number"]: r for r in gold.fact_pull_request(gold.pr_events(make(spark, *rows)), **options).collect()}


def test_first_response_is_by_someone_else_after_opening(spark):
    got = fact(spark, opened(1, 0), comment(1, 1, "ann"), review(1, 3, "bob"), review(1, -1, "eve"), review(1, 5, "cid"))[1]
    assert got["time_to_first_response_seconds"] == 10_800 and got["label_exclusion"] is None and got["is_censored"]


def test_every_exclusion(spark):
    got = fact(
        spark, opened(1, 0, None), opened(2, 0, draft=True), opened(3, None), opened(4, 0), opened(5, 0), closed(5, 2), review(6, 1, "bob"), opened(7, 0), closed(7, 4, False, "merged"),
    )
    assert {k: v["label_exclusion"] for k, v in got.items()} == {1: "author_unobserved", 2: "draft", 3: "open_unobserved", 4: "right_censored", 5: "closed_no_response", 6: "author_unobserved", 7: "closed_no_response"}
    assert got[7]["merged"] is False and got[5]["merged"] is True
    assert all(r["violations"] == 0 for r in gold.fact_violations(gold.fact_pull_request(gold.pr_events(make(spark, opened(1, 0), opened(2, 0, draft=True))))).collect())


def test_issue_comments_count_only_for_pull_requests(spark):
    got = fact(spark, opened(1, 0), comment(1, 1, "bob", False), opened(2, 0), comment(2, 1, "bob", None), comment(9, 1, "bob", None))
    assert got[1]["label_exclusion"] == "right_censored" and got[2]["time_to_first_response_seconds"] == 3600 and 9 not in got


def test_bots_answer_unless_only_people_count(spark):
    rows = (opened(1, 0), comment(1, 1, "ci[bot]"), comment(1, 2, "bob"))
    assert fact(spark, *rows)[1]["time_to_first_response_seconds"] == 3600
    assert fact(spark, *rows, responders="human_only")[1]["time_to_first_response_seconds"] == 7200
    with pytest.raises(ValueError):
        fact(spark, *rows, responders="x")


def test_earliest_opening_and_closing_win(spark):
    got = fact(spark, opened(1, 5, "late"), opened(1, 0, "first"), closed(1, 9, False), closed(1, 7, True))[1]
    assert got["author_login"] == "first" and got["merged"] is True


def test_incremental_equals_full(spark):
    rows = [opened(k, k % 7) for k in range(30)] + [review(k, 10 + k % 5, "bob") for k in range(0, 30, 3)] + [closed(k, 20 + k % 3) for k in range(0, 30, 4)]
    life = gold.pr_events(make(spark, *rows))
    full = gold.fact_pull_request(life)
    for cut in (h(3), h(12), h(22)):
        prior = gold.fact_pull_request(life.where(F.col("ingested_at") < F.lit(cut)))
        assert gold.fact_incremental(prior, life, cut).exceptAll(full).count() == 0
        assert gold.fact_incremental(full, life, cut).exceptAll(full).count() == 0  # again changes nothing


def test_fact_needs_one_exchange_by_pull_request(spark):
    life = spark.createDataFrame([], "repo_id long, pr_number long, kind string, at timestamp, actor_login string, draft boolean, merged boolean, ingested_at timestamp")
    plan = gold.fact_pull_request(life)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_daily(spark):
    df = make(spark, opened(1, 0), closed(1, 2, action="merged"), comment(1, 30, "x[bot]")).withColumn("push_size", F.lit(3)).withColumn("push_distinct_size", F.lit(2))
    got = sorted(gold.agg_repo_daily(df).collect(), key=lambda r: r["activity_date"])
    assert [(r["events_total"], r["prs_opened"], r["prs_closed"], r["bot_events"], r["commits_pushed"]) for r in got] == [(2, 1, 1, 0, None), (1, 0, 0, 1, None)]


def names(spark, *rows):
    return spark.createDataFrame([(k, n, h(t), e) for k, n, t, e in rows], "repo_id long, repo_name string, created_at timestamp, event_id string")


def test_names_by_event_time(spark):
    got = gold.name_history(names(spark, (1, "acme/glb", 0, "a"), (1, "acme/GLB", 5, "b"), (1, "acme/GLB", 6, "c"), (1, "acme/final", 9, "d"), (2, "x", 1, "e"), (None, "y", 1, "f"))).select("repo_id", "repo_name", (F.unix_timestamp("valid_to") - F.unix_timestamp("valid_from")).alias("s")).collect()
    assert {tuple(r) for r in got} == {(1, "acme/glb", 5 * 3600), (1, "acme/GLB", 4 * 3600), (1, "acme/final", None), (2, "x", None)}


def test_names_by_run(spark):
    one = gold.snapshot_names(None, gold.latest_name(names(spark, (1, "a", 0, "a"), (2, "b", 0, "b"))), h(1))
    same = gold.snapshot_names(one, gold.latest_name(names(spark, (1, "a", 2, "c"))), h(3))
    assert same.exceptAll(one).count() == 0 and same.count() == 2
    new = gold.snapshot_names(same, gold.latest_name(names(spark, (1, "A", 4, "d"), (3, "n", 4, "e"))), h(5))
    rows = {(r["repo_id"], r["repo_name"], r["valid_to"] is None) for r in new.collect()}
    assert rows == {(1, "a", False), (1, "A", True), (2, "b", True), (3, "n", True)}


def test_author_history_counts_endings_strictly_before(spark):
    df = make(spark, opened(1, 0), closed(1, 2), opened(2, 2), closed(2, 5, False), opened(3, 3), opened(4, 6), opened(4, 7), closed(1, 8), closed(3, 5.5, None))
    got = {r["event_time"].timestamp(): (r["prior_pr_count"], r["prior_merge_rate"]) for r in features.author_activity(df).collect()}
    at = lambda n: h(n).timestamp()
    assert got == {at(0): (0, None), at(2): (0, None), at(3): (1, 1.0), at(6): (3, 0.5)}


def test_repo_activity_and_assembly_keep_every_spine_row(spark):
    df = make(spark, opened(1, 0), opened(2, 0, "r[bot]"), review(1, 1, "bob"), opened(3, 1, None), opened(5, None))
    act = features.repo_activity(df).orderBy("event_time").collect()
    assert [(r["events_total_to_date"], r["bot_events_to_date"], r["prs_opened_to_date"]) for r in act] == [(2, 1, 2), (4, 1, 3)]
    spine = features.pr_spine(df)
    out = features.assemble(spine, features.author_activity(df), features.repo_activity(df), features.pr_static(df)).collect()
    by = {r["pr_number"]: r for r in out}
    assert set(by) == {1, 2, 3, 5} and len(out) == 4
    assert by[1]["events_total_to_date"] is None and by[3]["events_total_to_date"] == 2 and by[3]["prior_pr_count"] is None


def test_ntile_by_counts_equals_ntile(spark):
    from pyspark.sql import Window

    for n in (7, 23, 100):
        df = spark.range(n).select(F.lit(1).alias("repo_id"), F.col("id").alias("pr_number"), (F.col("id") % 6 / 10).alias("breach_risk"), (F.col("id") % 3 == 0).alias("breach"))
        want = df.withColumn("d", F.ntile(10).over(Window.orderBy("breach_risk", "repo_id", "pr_number"))).groupBy("d").count()
        got = reports.calibration(df)
        assert sorted((r["risk_decile"], r["pull_requests"]) for r in got.collect()) == sorted(tuple(r) for r in want.collect())


def test_labels(spark):
    got = gold.fact_pull_request(gold.pr_events(make(spark, opened(1, 0), review(1, 1, "b"), opened(2, 0), review(2, 9, "b"), opened(3, 0), closed(3, 1), opened(4, 0))))
    assert {r["pr_number"]: r["breach"] for r in learning.breach_labels(got, 4 * 3600).collect()} == {1: False, 2: True, 3: True}
