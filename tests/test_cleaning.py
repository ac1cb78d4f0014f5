import json
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewater.functions import text as T
from tidewater.functions.payloads import CANONICAL, normalize_events, parse_events
from tidewater.operators import cleaning

NOW = datetime(2026, 1, 1, tzinfo=UTC)


def raw(spark, *events):
    rows = [(e if isinstance(e, str) else json.dumps(e), NOW, "f", "2026-01-01", 3) for e in events]
    return spark.createDataFrame(rows, "raw_json string, ingested_at timestamp, source_file string, event_date string, event_hour int")


LEGACY = {"type": "PushEvent", "created_at": "2013-03-01T10:00:00-07:00", "actor": "old", "repository": {"id": 4, "owner": "o", "name": "n"}, "url": "u", "payload": {"size": 3}}
MODERN = {"id": "77", "type": "PullRequestEvent", "created_at": "2020-03-01T10:00:00Z", "actor": {"id": 1, "login": "dev"}, "repo": {"id": 5, "name": "o/n"}, "payload": {"action": "closed", "pull_request": {"number": 8, "merged": True, "draft": False}}}
REDUCED = {"id": "78", "type": "PullRequestEvent", "created_at": "2025-11-01T10:00:00Z", "actor": {"login": "dev"}, "repo": {"id": 5, "name": "o/n"}, "payload": {"action": "merged", "pull_request": {"number": 8}}}


def test_three_eras_and_broken_lines(spark):
    out = normalize_events(parse_events(raw(spark, LEGACY, MODERN, REDUCED, "{not json at all", {**MODERN, "created_at": "junk"}, {**MODERN, "type": "New", "x": [1]})))
    assert tuple(out.columns) == CANONICAL
    old, new, cut, broken, undated, other = out.collect()
    assert (old["schema_era"], old["actor_login"], old["repo_name"], old["push_size"], old["push_distinct_size"]) == ("legacy_v1", "old", "o/n", 3, None)
    assert old["event_id_source"] == "content_hash" and len(old["event_id"]) == 64
    assert (new["schema_era"], new["event_id"], new["pr_merged"], new["pr_draft"], new["pr_number"]) == ("modern_v2", "77", True, False, 8)
    assert (cut["schema_era"], cut["pr_merged"], cut["pr_draft"]) == ("reduced_v3", True, None)
    assert broken["event_id"] is None and broken["schema_era"] is None and broken["created_at"] is None
    assert undated["created_at"] is None and undated["schema_era"] is None and undated["event_id"] == "77"
    assert other["event_type"] == "New"
    assert out.select(F.unix_timestamp("created_at")).first()[0] == int(datetime(2013, 3, 1, 17, tzinfo=UTC).timestamp())


def test_closed_is_not_merged_only_where_the_era_says_so(spark):
    closed = {**REDUCED, "payload": {"action": "closed", "pull_request": {"number": 8}}}
    opened = {**REDUCED, "payload": {"action": "opened", "pull_request": {"number": 8}}}
    issue = {**REDUCED, "type": "IssuesEvent", "payload": {"action": "closed", "issue": {"number": 2}}}
    assert [r["pr_merged"] for r in parse_events(raw(spark, closed, opened, issue)).collect()] == [False, None, None]


def test_comment_flag_is_unknown_in_the_old_era(spark):
    def comment(at, **issue):
        return {"id": "1", "type": "IssueCommentEvent", "created_at": at, "payload": {"issue": {"number": 2, **issue}}}

    rows = raw(spark, comment("2013-01-01T00:00:00Z"), comment("2020-01-01T00:00:00Z"), comment("2020-01-01T00:00:00Z", pull_request={"url": "x"}), comment("2025-12-01T00:00:00Z", pull_request={}))
    assert [r["is_pr_comment"] for r in normalize_events(parse_events(rows)).collect()] == [None, False, True, True]


def test_hash_tells_null_from_empty_and_agrees_across_zones(spark):
    a, b, c = normalize_events(parse_events(raw(spark, LEGACY, {**LEGACY, "url": ""}, {**LEGACY, "created_at": "2013-03-01T17:00:00Z"}))).collect()
    assert a["event_id"] != b["event_id"] and a["event_id"] == c["event_id"]


def test_dedup_is_deterministic_and_keeps_null_ids(spark):
    t = lambda m: NOW + timedelta(minutes=m)
    rows = [("a", t(2), 1, t(0)), ("a", t(1), 2, t(5)), ("a", t(1), 3, t(4)), (None, t(1), 4, t(1)), (None, t(1), 4, t(1)), ("b", None, 5, t(1)), ("b", t(9), 6, t(1))]
    df = spark.createDataFrame(rows, "event_id string, created_at timestamp, n long, ingested_at timestamp")
    got = sorted((r["event_id"] or "", r["n"]) for r in cleaning.deduplicate(df).collect())
    assert got == [("", 4), ("", 4), ("a", 3), ("b", 6)]
    assert tuple(cleaning.duplicate_stats(df).first()) == (5, 2, 3)
    assert "WindowGroupLimit" in cleaning.deduplicate(df)._jdf.queryExecution().executedPlan().toString()


GOOD = ("e", NOW, NOW, 1, "a", "T")


@pytest.mark.parametrize(
    ("row", "failed"),
    [
        (GOOD, []),
        ((None, NOW, NOW, 1, "a", "T"), ["event_id_present"]),
        (("", NOW, NOW, 1, "a", "T"), ["event_id_present"]),
        (("e", None, NOW, 1, "a", "T"), ["created_at_present", "created_at_not_future"]),
        (("e", NOW + timedelta(1), NOW, 1, "a", "T"), ["created_at_not_future"]),
        (("e", NOW, None, 1, "a", "T"), ["created_at_not_future"]),
        (("e", NOW, NOW, None, "a", "T"), ["repo_id_present"]),
        (("e", NOW, NOW, 1, None, "T"), []),
        (("e", NOW, NOW, 1, "a", None), ["event_type_present"]),
    ],
)
def test_every_rule_fires(spark, row, failed):
    df = spark.createDataFrame([row], "event_id string, created_at timestamp, ingested_at timestamp, repo_id long, actor_login string, event_type string")
    annotated = cleaning.apply_rules(df)
    clean, bad = cleaning.split(annotated)
    assert annotated.first()[cleaning.FAILED] == failed
    assert (clean.count(), bad.count()) == (int(not failed), int(bool(failed))) and clean.columns == df.columns
    warned = df.select(cleaning.warnings().alias("w")).first()["w"]
    assert warned == (["actor_login_present"] if row[4] is None else [])


def test_rules_need_names_of_their_own(spark):
    with pytest.raises(ValueError):
        cleaning.apply_rules(spark.range(1), [cleaning.Rule("a", "true"), cleaning.Rule("a", "false")])
    with pytest.raises(ValueError):
        cleaning.Rule("a", "true", "maybe")


def test_gaps(spark):
    start = datetime(2024, 1, 1, tzinfo=UTC)
    report = cleaning.GapReport.of(start, start + timedelta(hours=3), {start, start + timedelta(hours=2)})
    assert (report.expected, report.present, [m.hour for m in report.missing], report.complete) == (4, 2, [1, 3], False)
    present = spark.createDataFrame([(start,), (start,), (None,)], "hour timestamp")
    got = cleaning.missing_hours(cleaning.expected_hours(spark, start, start + timedelta(hours=2)), present)
    assert sorted(r[0] for r in got.select(F.hour("hour")).collect()) == [1, 2]
    assert cleaning.expected_hours(spark, start, start - timedelta(hours=1)).count() == 0


def test_empty_window_names_one_rule(spark):
    df = spark.createDataFrame([], "event_type string, event_action string, created_at timestamp, pr_draft boolean")
    assert cleaning.window_profile(df).first()["failed_rules"] == ["no_events"]


LOGINS = {"dependabot[bot]": "suffix", "Renovate": "known", "my-bot": "pattern", "releaseAutomation": "pattern", "x-ci": "pattern", "buildCI": "pattern", "marci": "none", "CI": "none", "botanist": "none", "": "none"}


def test_bots_agree_between_spark_and_python(spark):
    df = spark.createDataFrame([(k,) for k in LOGINS], "login string")
    got = {r[0]: r[1] for r in df.select("login", T.is_bot(F.col("login"))).collect()}
    assert got == {k: v != "none" for k, v in LOGINS.items()} and {k: T.bot_clause(k) for k in LOGINS} == LOGINS
    assert spark.createDataFrame([(None,)], "l string").select(T.is_bot(F.col("l"))).first()[0] is None


def test_small_functions():
    at = lambda d: datetime(2024, 1, d, tzinfo=UTC)
    assert T.renames([(1, "b", at(2)), (1, "a", at(1)), (2, "x", at(1)), (1, "b", at(3))]) == [(1, "a", "b", at(2))]
    assert T.repeat_share(["a", "a", "b", "b"]) == 0.5 and T.repeat_share([]) == 0
    assert T.field_paths({"a": {"b": {"c": 1}}, "d": 1}) == {"a", "a.b", "d"}
    assert T.compare_paths({"a", "b"}, {"b", "c"}) == ({"a"}, {"c"}, {"b"})
    assert [T.era_of(datetime(y, 12, 31, tzinfo=UTC)) for y in (2014, 2015, 2025)] == list(T.ERAS)


def test_entity_keys(spark):
    keys = ["pr:1:2", "pr:1", "pr:x:2", "pr:1:2:3", ":1:2", None]
    got = [r[0] for r in spark.createDataFrame([(k,) for k in keys], "k string").coalesce(1).select(T.split_entity_key(F.col("k"))).collect()]
    assert tuple(got[0]) == ("pr", 1, 2) and got[1:] == [None] * 5
