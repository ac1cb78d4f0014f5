import json
from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewater.plans import backfill, features
from tidewater.sources import archive, config, poller, snapshots
from tidewater.sources.snapshots import Contract, ContractError, SnapshotStore
from tidewater.streaming import ingest, online, replay

T0 = datetime(2025, 11, 3, tzinfo=UTC)


def test_versions_appends_upserts_and_changes(spark, tmp_path):
    t = SnapshotStore(spark, f"file://{tmp_path}").table("t")
    contract = Contract({"id": "bigint", "v": "bigint"}, ["id"], {"small": "v < 100"})
    one = spark.range(3).select("id", (F.col("id") * 2).alias("v"))
    assert t.version == -1 and t.write(one, contract) == 0
    assert t.append(spark.createDataFrame([(9, 9)], "id long, v long"), contract) == 1
    assert t.upsert(spark.createDataFrame([(1, 50), (7, 7)], "id long, v long"), ["id"], contract) == 2
    rows = lambda v=None: sorted(tuple(r) for r in t.read(v).collect())
    assert rows(0) == [(0, 0), (1, 2), (2, 4)] and rows(1) == [(0, 0), (1, 2), (2, 4), (9, 9)] and rows() == [(0, 0), (1, 50), (2, 4), (7, 7), (9, 9)]
    assert t.changes(0).count() == 6 and len(t.history()) == 3
    with pytest.raises(LookupError):
        t.read(5)


@pytest.mark.parametrize(
    ("rows", "schema", "said"),
    [
        ([(1,)], "id long", "missing column v"),
        ([(1, 2, 3)], "id long, v long, x long", "unexpected column x"),
        ([(1, 2)], "id int, v long", "column id is int"),
        ([(None, 2)], "id long, v long", "id_not_null: 1"),
        ([(1, 2), (1, 3)], "id long, v long", "duplicate_key: 1"),
        ([(1, 200)], "id long, v long", "small: 1"),
        ([(1, None)], "id long, v long", "small: 1"),
    ],
)
def test_contracts_refuse_and_write_nothing(spark, tmp_path, rows, schema, said):
    t = SnapshotStore(spark, str(tmp_path)).table("t")
    with pytest.raises(ContractError, match=said):
        t.write(spark.createDataFrame(rows, schema), Contract({"id": "bigint", "v": "bigint"}, ["id"], {"small": "v < 100"}))
    assert t.version == -1


def test_pins_are_all_or_none(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    assert store.pins(None, ["a", "b"]) == {"a": None, "b": None} and store.pins({"a": 1, "b": 2}, ["a", "b"]) == {"a": 1, "b": 2}
    with pytest.raises(ValueError, match="missing b"):
        store.pins({"a": 1}, ["a", "b"])


def test_pinned_features_survive_a_late_event(spark, tmp_path):
    schema = "event_id string, repo_id long, pr_number long, created_at timestamp, event_type string, event_action string, actor_login string, pr_merged boolean, pr_draft boolean"
    rows = [(str(k), 1, k, T0 + timedelta(hours=k), "PullRequestEvent", "opened", "ann", None, False) for k in range(5)]
    store = SnapshotStore(spark, str(tmp_path))
    first = features.build_features(store, spark.createDataFrame(rows, schema))
    before = store.table("repo_activity").read(first["repo_activity"]).collect()
    late = [("x", 1, 77, T0 + timedelta(minutes=30), "PullRequestEvent", "opened", "bob", None, False)]
    second = features.build_features(store, spark.createDataFrame(rows + late, schema))
    assert sorted(store.table("repo_activity").read(first["repo_activity"]).collect()) == sorted(before)
    assert sorted(store.table("repo_activity").read(second["repo_activity"]).collect()) != sorted(before)


def test_partitions_are_replaced_even_by_nothing(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(4).select("id", F.lit("2024-01-01").alias("event_date"))
    for rows in (df, df.limit(2), df.limit(0)):
        snapshots.replace_partition(rows, path, event_date="2024-01-01")
        snapshots.replace_partition(df.limit(1), path, event_date="2024-01-02")
        assert snapshots.read_partition(spark, path, event_date="2024-01-01").count() == rows.count()
        plan = snapshots.read_partition(spark, path, event_date="2024-01-02")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(event_date" in plan


def test_key_statements():
    assert snapshots.key_ddl("s", "t", ["a"], "time")[2] == "ALTER TABLE s.t ADD CONSTRAINT t_pk PRIMARY KEY (a, time TIMESERIES)"


def event(i, minutes, **more):
    return {"id": str(i), "type": "PushEvent", "created_at": (T0 + timedelta(minutes=minutes)).strftime("%Y-%m-%dT%H:%M:%SZ"), "actor": {"login": f"u{i % 3}"}, "repo": {"id": i % 4, "name": "o/n"}, "payload": {}} | more


def run(spark, tmp_path, **options):
    query = ingest.write_stream(ingest.stream_events(spark, str(tmp_path / "landing"), **options), str(tmp_path / "silver"), str(tmp_path / "check"), quarantine=str(tmp_path / "bad"))
    query.awaitTermination()
    return ingest.read_silver(spark, str(tmp_path / "silver"))


def test_stream_equals_batch_under_lateness_repeats_and_restarts(spark, tmp_path):
    events = [event(k, k * 7) for k in range(240)]
    stats = replay.replay(events, tmp_path / "all", cycles=6, late_share=0.1, repeat_share=0.3, shuffle=True, seed=4)
    assert stats.delivered == 240 + stats.repeated and stats.late > 5 and stats.repeated > 20
    listener = ingest.MetricsListener()
    spark.streams.addListener(listener)
    files = sorted((tmp_path / "all").iterdir())
    (tmp_path / "landing").mkdir()
    for part in (files[:2], files[2:4], files[4:]):  # three runs of one query
        for f in part:
            f.rename(tmp_path / "landing" / f.name)
        got = run(spark, tmp_path, max_files=1)
    rows = got.collect()
    assert sorted(int(r["event_id"]) for r in rows) == list(range(240))
    assert sum(r["is_late"] for r in rows) >= stats.late
    assert {r["event_date"] for r in rows} == {"2025-11-03", "2025-11-04"}
    spark.streams.removeListener(listener)


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    landed = [json.dumps({"polled_at": T0.isoformat(), "event": json.dumps(event(k, k))}) for k in range(20)]
    df = ingest.to_silver(spark.createDataFrame([tuple(json.loads(x).values()) for x in landed], ingest.LANDING), 600)
    dest = str(tmp_path / "silver")
    assert ingest.land_batch(df, dest, 0) == 20 and ingest.land_batch(df, dest, 0) == 20 and ingest.land_batch(df, dest, 1) == 0
    assert ingest.read_silver(spark, dest).count() == 20


def test_unidentified_and_undated_events(spark, tmp_path):
    rows = [(T0.isoformat(), "{broken"), (T0.isoformat(), json.dumps(event(1, 1)))]
    with pytest.raises(ingest.StreamRejected):
        ingest.land_batch(ingest.to_silver(spark.createDataFrame(rows, ingest.LANDING), 600), str(tmp_path / "s"), 0)
    rows = [(T0.isoformat(), json.dumps(event(2, 1, created_at="junk"))), rows[1]]
    df = ingest.to_silver(spark.createDataFrame(rows, ingest.LANDING), 600)
    with pytest.raises(ingest.StreamRejected):
        ingest.land_batch(df, str(tmp_path / "s"), 0)
    assert ingest.land_batch(df, str(tmp_path / "s"), 0, quarantine=str(tmp_path / "bad")) == 1
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 1


def test_online_store(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    source = store.table("f")
    row = lambda k, h, v: (k, T0 + timedelta(hours=h), v)
    make = lambda *rows: spark.createDataFrame(rows, "k long, t timestamp, v long")
    source.write(make(row(1, 0, 1), row(1, 2, 2), row(2, 1, 3)))
    served = online.OnlineStore(store)
    with pytest.raises(LookupError):
        served.publish("f", "o", ["k"], "t")
    served.create().publish("f", "o", ["k"], "t")
    source.append(make(row(1, 1, 9), row(2, 5, 7), row(3, 0, 1)))
    served.publish("f", "o", ["k"], "t")
    assert sorted((r["k"], r["v"]) for r in store.table("o").read().collect()) == [(1, 2), (2, 7), (3, 1)]
    with pytest.raises(ValueError):
        served.publish("f", "o", ["k"], "t", "sometimes")
    served.delete()
    served.delete()


def test_fetching(tmp_path):
    calls = []

    def get(url):
        calls.append(url)
        hour = int(url.rsplit("-", 1)[1].split(".")[0])
        if hour == 3:
            raise RuntimeError("boom")
        return {0: (200, b"x"), 1: (404, b""), 2: (200, b""), 4: (500, b""), 5: (403, b"")}[hour]

    waits = []
    got = archive.fetch_hours(get, "http://a/", [(date(2024, 1, 2), k) for k in range(6)], str(tmp_path), tries=3, sleep=waits.append)
    assert [f.outcome.value for f in got] == ["ok", "absent", "empty", "failed", "failed", "failed"]
    assert (tmp_path / "2024-01-02-0.json.gz").read_bytes() == b"x" and len(waits) == 2 and len(calls) == 8
    assert "http://a/2024-01-02-0.json.gz" in calls
    assert len(list(archive.hours_between(datetime(2024, 1, 1, 22), datetime(2024, 1, 2, 1)))) == 4


def test_polling(tmp_path):
    pages = {
        "u": poller.Response(200, {"ETag": "t1", "Link": '<u2>; rel="next", <u9>; rel="last"', "X-Poll-Interval": "90", "X-RateLimit-Remaining": "7"}, [{"id": 1}, {"id": 2}]),
        "u2": poller.Response(200, {}, [{"id": 2}, {"id": 3}]),
    }
    waits, refused = [], [poller.Response(429, {"Retry-After": "5", "X-RateLimit-Reset": "100"})]

    def get(url, headers):
        if refused:
            return refused.pop()
        if headers.get("If-None-Match") == "t1":
            return poller.Response(304)
        return pages[url]

    client = poller.Client(get, "secret", waits.append, lambda: 50.0)
    one = poller.poll_once(client, "u")
    assert [e["id"] for e in one.events] == [1, 2, 3] and (one.etag, one.interval, one.remaining, waits) == ("t1", 90, 7, [5.0])
    assert poller.poll_once(client, "u", "t1").unchanged
    stats = poller.run_poller(client, "u", str(tmp_path), 2)
    assert stats == {"polls": 2, "events": 3, "files": 1, "unchanged": 1}
    assert poller.wait_for(poller.Response(403, {"X-RateLimit-Reset": "80"}), 50) == 30
    with pytest.raises(poller.RequestFailed):
        poller.Client(lambda u, h: poller.Response(500)).ask("x")
    assert poller.capture([["a", "b"], ["b", "c"]], 6) == {"distinct": 3, "mean_overlap": 0.5, "captured": 0.5}


def test_configs():
    made = config._strict(config.FileSource, {"name": "n", "url_template": "u", "quality_rules": [{"name": "a", "expression": "true"}]})
    assert made.quality_rules[0].severity == "reject"
    for bad in ({"name": "n"}, {"name": "n", "url_template": "u", "x": 1}, {"name": "n", "url_template": "u", "quality_rules": [{"name": "a", "expression": "1"}] * 2}):
        with pytest.raises(config.ConfigError):
            config._strict(config.FileSource, bad)


def test_backfill_resumes_and_conserves_rows(spark, tmp_path):
    import gzip

    def fetch(day):
        out = []
        for hour in (0, 1):
            path = tmp_path / f"{day}-{hour}.json.gz"
            lines = [json.dumps(event(hour * 10 + k, 60 * hour + k)) for k in range(5)] + ["{broken"]
            path.write_bytes(gzip.compress("\n".join(lines).encode()))
            out.append(archive.Fetched(day, hour, archive.Outcome.OK, str(path), path.stat().st_size))
        return [*out, archive.Fetched(day, 2, archive.Outcome.ABSENT)]

    lake, markers = f"file://{tmp_path}/lake", backfill.Markers(tmp_path / "done")
    day = date(2025, 11, 3)
    (one,) = backfill.backfill(spark, day, day, fetch, lake, markers, datetime(2026, 1, 1, tzinfo=UTC))
    assert (one.clean, one.quarantined, one.missing, one.hours) == (10, 2, [2], 2)
    assert backfill.read_clean(spark, lake).count() == 10 and backfill.read_quarantine(spark, lake).count() == 2
    again = backfill.process_day(spark, day, fetch(day), lake, datetime(2026, 1, 1, tzinfo=UTC))
    assert (again.clean, again.quarantined) == (10, 2)
    assert backfill.pending_days(day, day + timedelta(days=1), markers.done()) == [day + timedelta(days=1)]
    assert backfill.compare_engines([{"a": 2.0}, {"a": 3.0}], [{"a": 1.0}, {"a": 1.6}])["a"]["verdict"] == "helped"
