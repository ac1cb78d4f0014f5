"""Queries that go through stored tables, archives, streams and tools: what was
written is read back and compared with SQL over the tables it came from."""

from __future__ import annotations

from datetime import UTC, date, datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalogue import CANONICAL, DIRTY, FACT, FAILED, SCORED, _dirty, _raw, canonical, fact, query, r6, scored, secs
from .functions import grounding
from .functions import text as T
from .operators import drift, learning, retrieval
from .plans import backfill, features, gold, probes
from .plans.serving import Request, Tools
from .sources import archive
from .sources.snapshots import Contract, ContractError, SnapshotStore, SnapshotTable, catalogue_locations, register
from .sources.tables import freshness, read_archive, scan, work_folder
from .streaming import ingest, online

DAY = datetime(2024, 1, 1, tzinfo=UTC)


def _paths(spark: SparkSession, folder: str) -> list:
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [fs, *[s.getPath() for s in fs.listStatus(p)]]


def _archives(spark: SparkSession, rows: DataFrame, name: str) -> dict[str, str]:
    """File name -> path of hourly archives: the lines (column line) of each name."""
    root = work_folder(spark, "archive")
    rows.select(name, "line").repartition(name).write.partitionBy(name).option("compression", "gzip").text(root)
    out = {}
    fs, *folders = _paths(spark, root)
    for folder in folders:
        if "=" in folder.getName():
            title = folder.getName().partition("=")[2]
            part = next(p for p in _paths(spark, folder.toString())[1:] if p.getName().startswith("part-"))
            target = spark._jvm.org.apache.hadoop.fs.Path(root, f"{title}.json.gz")
            fs.rename(part, target)
            out[title] = target.toString()
    return out


# ---- sources


@query("select '2024-01-01-' || hour(ts) || '.json.gz' source_file, '2024-01-01' event_date, cast(hour(ts) as integer) event_hour, cast(1704067200 as bigint) ingested_s, cast(count(*) as bigint) lines, cast(sum(event_id) as bigint) ids from events group by 1, 2, 3")
def archive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = scan(spark, sf_dir, "events")
    lines = e.select(F.concat(F.lit("2024-01-01-"), F.hour("ts")).alias("name"), F.concat(F.lit('{"id":'), F.col("event_id"), F.lit("}")).alias("line"))
    rows = read_archive(spark, sorted(_archives(spark, lines, "name").values()), DAY)
    found = rows.groupBy("source_file", "event_date", "event_hour", secs("ingested_at").alias("ingested_s"))
    return found.agg(F.count("*").alias("lines"), F.sum(F.get_json_object("raw_json", "$.id").cast("long")).alias("ids"))


@query("select 'http://x/' || strftime(t, '%Y-%m-%d') || '-' || hour(t) || '.json.gz' url from (select unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)), interval 1 hour)) t from events)")
def archive_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = scan(spark, sf_dir, "events").agg(F.unix_timestamp(F.min("ts")).alias("a"), F.unix_timestamp(F.max("ts")).alias("b")).first()
    hours = archive.hours_between(datetime.fromtimestamp(one["a"], UTC), datetime.fromtimestamp(one["b"], UTC))
    return spark.createDataFrame([(archive.archive_url("http://x/", d, h),) for d, h in hours], "url string")


@query("""with s as (select case event_type when 'error' then 500 when 'view' then 404 else 200 end status, event_id % 3 size from events)
select case when status = 404 then 'absent' when status <> 200 then 'failed' when size > 0 then 'ok' else 'empty' end outcome, cast(count(*) as bigint) responses from s group by 1""")
def response_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("event_type") == "error", 500).when(F.col("event_type") == "view", 404).otherwise(200)
    kinds = scan(spark, sf_dir, "events").groupBy(status.alias("status"), (F.col("event_id") % 3).alias("size")).count().collect()  # nine at most
    out: dict[str, int] = {}
    for r in kinds:
        name = archive.outcome_of(r["status"], r["size"]).value
        out[name] = out.get(name, 0) + r["count"]
    return spark.createDataFrame(sorted(out.items()), "outcome string, responses long")


@query("""select 'v' || v "version", cast(count(*) as bigint) n, round(sum(case when v = 2 and event_id % 6 = 0 then value + 100 else value end), 3) total from events, (values (0), (1), (2)) t(v)
where event_id % 3 = 0 or v > 0 and event_id % 3 = 1 group by 1
union all select 'changes', cast(count(*) as bigint), round(sum(value), 3) from events where event_id % 3 = 1
union all select 'pinned', cast(count(*) as bigint), round(sum(value), 3) from events where event_id % 3 = 0""")
def table_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written, appended to and upserted: every version, the rows added, a pinned read by name."""
    e, m = scan(spark, sf_dir, "events").select("event_id", "value"), F.col("event_id")
    store = SnapshotStore(spark, work_folder(spark, "versions"))
    t = store.table("events")
    t.write(e.where(m % 3 == 0))
    t.append(e.where(m % 3 == 1), Contract.of(e.schema, ["event_id"]))
    added = t.changes(0)
    t.upsert(e.where(m % 6 == 0).withColumn("value", F.col("value") + 100), ["event_id"])
    frames = {f"v{v}": t.read(v) for v in range(3)} | {"changes": added, "pinned": store.read("events", store.pins({"events": 0}, ["events"]))}
    out = None
    for name, df in frames.items():
        one = df.agg(F.count("*").alias("n"), F.round(F.sum("value"), 3).alias("total")).select(F.lit(name).alias("version"), "n", "total")
        out = one if out is None else out.unionByName(one)
    return out


@query("""select * from (values (1, 'added', 'event_id_not_null'), (1, 'added', 'positive'), (2, 'added', 'known_user'), (3, 'dropped', 'positive')) t(step, action, name)
union all select 4, 'refused', 'cheap: ' || count(*) || ' rows' from events where not coalesce(value < 50, false)
union all select 5, 'refused', 'known_user: ' || count(*) || ' rows' from events""")
def constraint_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = scan(spark, sf_dir, "events").select("event_id", "user_id", "value")
    t = SnapshotTable(spark, work_folder(spark, "constraints") + "/t")
    t.write(e)
    kinds, out = Contract.of(e.schema, ["event_id"]).columns, []
    for step, checks in enumerate(({"positive": "value >= 0"}, {"positive": "VALUE  >= 0", "known_user": "user_id >= 0"}, {"known_user": "user_id >= 0"}, {"known_user": "user_id >= 0", "cheap": "value < 50"}), 1):
        try:
            done = t.apply_constraints(Contract(kinds, ["event_id"], checks))
            out += [(step, action, name) for action, names in done.items() for name in names]
        except ContractError as error:
            out.append((step, "refused", str(error)))
    try:
        t.write(e.withColumn("user_id", -F.col("user_id") - 1))
    except ContractError as error:
        out.append((5, "refused", str(error)))
    return spark.createDataFrame(out, "step int, action string, name string")


@query("select event_type, cast(count(*) as bigint) n, true registered from events group by 1")
def registered_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An external table by its name, and the catalogue's entry for it."""
    root = work_folder(spark, "external")
    scan(spark, sf_dir, "events").select("event_type").write.parquet(root)
    name = "t_" + root.rpartition("-")[2]
    register(spark, name, root)
    register(spark, name, root)  # again changes nothing
    try:
        there = catalogue_locations(spark, ["default"]).where(F.col("full_name") == f"default.{name}").select(F.col("storage_path").endswith(root.rpartition("/")[2]).alias("registered"))
        return spark.read.table(name).groupBy("event_type").agg(F.count("*").alias("n")).crossJoin(F.broadcast(spark.createDataFrame(there.collect(), "registered boolean")))  # one row
    finally:
        spark.sql(f"DROP TABLE {name}")


@query("""with n as (select max(ts) t from events) select h "hours", cast(floor(epoch(t)) as bigint) newest, cast(h * 3600 as bigint) age_seconds, case when h > 24 then 'error' when h > 6 then 'warn' else 'pass' end state from n, (values (1), (6), (7), (24), (25)) v(h)""")
def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = scan(spark, sf_dir, "events").select(F.timestamp_seconds(secs("ts")).alias("ingested_at"))
    newest, out = e.agg(F.unix_timestamp(F.max("ingested_at")).alias("s")).first()["s"], None
    for hours in (1, 6, 7, 24, 25):
        one = freshness(e, datetime.fromtimestamp(newest, UTC) + timedelta(hours=hours)).select(F.lit(hours).alias("hours"), secs("newest").alias("newest"), "age_seconds", "state")
        out = one if out is None else out.unionByName(one)
    return out


@query(f"with d as ({DIRTY}), f as (select '2024-01-0' || (1 + cast(n as bigint) % 3) event_date, {FAILED} failed from d) select event_date, cast(count(*) filter (failed = '') as bigint) clean, cast(count(*) filter (failed <> '') as bigint) quarantined from f group by 1")
def silver_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days written one by one, one of them twice: a day is replaced, not added to."""
    from .operators.cleaning import apply_rules

    root = work_folder(spark, "silver")
    rows = apply_rules(_dirty(spark, sf_dir)).withColumn("event_date", F.concat(F.lit("2024-01-0"), (F.col("n").cast("long") % 3 + 1).cast("string")))
    for day in ("2024-01-01", "2024-01-02", "2024-01-03", "2024-01-02"):
        backfill.write_silver(rows.where(F.col("event_date") == day), root, day)
    ok = backfill.read_clean(spark, root).select("event_date", F.lit(1).alias("clean"), F.lit(0).alias("quarantined"))
    bad = backfill.read_quarantine(spark, root).select("event_date", F.lit(0).alias("clean"), F.lit(1).alias("quarantined"))
    return ok.unionByName(bad).groupBy(F.col("event_date").cast("string").alias("event_date")).agg(F.sum("clean").alias("clean"), F.sum("quarantined").alias("quarantined"))


@query("""with e as (select event_id, '2020-01-0' || (1 + event_id % 2) as "day", event_id % 4 as h from events)
select "day", cast(count(distinct h) as bigint) "hours", cast(count(*) filter (event_id % 40 <> 0) as bigint) clean, cast(count(*) filter (event_id % 40 = 0) as bigint) quarantined from e group by 1""")
def backfilled_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days of archives to Silver, marked; a second run finds nothing to do."""
    raw = _raw(spark, sf_dir).where("n % 3 > 0").unionByName(_raw(spark, sf_dir).where("n % 3 = 0").withColumn("raw_json", F.regexp_replace("raw_json", '"type"', '"x":0,"type"')))
    lines = raw.select(F.concat(F.lit("2020-01-0"), F.col("n") % 2 + 1, F.lit("-"), F.col("n") % 4).alias("name"), F.col("raw_json").alias("line"))
    paths = _archives(spark, lines, "name")

    def fetch(day: date) -> list[archive.Fetched]:
        return [archive.Fetched(day, h, archive.Outcome.OK, paths[f"{day}-{h}"], 1) for h in range(24) if f"{day}-{h}" in paths]

    import tempfile

    lake, markers = work_folder(spark, "lake"), backfill.Markers(tempfile.mkdtemp(prefix="markers-"))  # markers are the driver's own
    days = date(2020, 1, 1), date(2020, 1, 2)
    done = backfill.backfill(spark, *days, fetch, lake, markers, datetime(2026, 1, 1, tzinfo=UTC))
    again = backfill.backfill(spark, *days, fetch, lake, markers, datetime(2026, 1, 1, tzinfo=UTC))
    return spark.createDataFrame([(d.day, d.hours, d.clean, d.quarantined) for d in done + again], "day string, hours long, clean long, quarantined long")


# ---- events


@query("""select 'pr:' || user_id || ':' || event_id entity_key, cast(floor(epoch(ts)) as bigint) at_s, sha256('T' || event_type || chr(10) || chr(10) || 'body ' || user_id) text_hash
from events where event_id % 2 = 0 and event_id % 5 <> 0 and event_id % 7 <> 0""")
def extracted_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, i = scan(spark, sf_dir, "events"), F.col("event_id")
    pull = F.struct(i.alias("number"), F.concat(F.lit("T"), "event_type").alias("title"), F.when(i % 5 != 0, F.concat(F.lit("body "), "user_id")).alias("body"))
    repo = F.when(i % 7 != 0, F.struct(F.col("user_id").alias("id")))
    payload = F.struct(F.when(i % 2 == 0, "opened").otherwise("closed").alias("action"), pull.alias("pull_request"))
    raw = e.select(F.to_json(F.struct(F.lit("PullRequestEvent").alias("type"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"), repo.alias("repo"), payload.alias("payload"))).alias("raw_json"))
    return retrieval.extract_texts(raw).select("entity_key", secs("event_time").alias("at_s"), "text_hash")


@query("""select repo_id, created_at < ingested_at as later, epoch(ingested_at) - epoch(created_at) > 1800 is_late, cast(count(*) as bigint) events from c group by 1, 2, 3""".replace("from c", f"from ({CANONICAL}) c"))
def late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = T.is_late(F.col("created_at"), F.col("ingested_at"), 1800)
    return canonical(spark, sf_dir).groupBy("repo_id", (F.col("created_at") < F.col("ingested_at")).alias("later"), late.alias("is_late")).agg(F.count("*").alias("events"))


@query("select concat_ws(',', case when event_id % 4 = 0 or event_id % 9 = 0 then 'value' end, case when event_id % 6 = 0 then 'kind' end) missing, cast(count(*) as bigint) n from events group by 1")
def rows_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    e = scan(spark, sf_dir, "events").select(F.when(i % 9 == 0, float("nan")).when(i % 4 != 0, F.col("value")).alias("value"), F.when(i % 6 != 0, F.col("event_type")).alias("kind"), "user_id")
    return e.groupBy(F.concat_ws(",", drift.missing_names(e.schema, ["value", "kind", "user_id"])).alias("missing")).agg(F.count("*").alias("n"))


NAMED = "select user_id, event_id, ts, case when day(ts) < 10 then 'a' when day(ts) < 20 then 'A' else event_type end name from events"


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.dayofmonth("ts")
    return scan(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").alias("created_at"), F.when(day < 10, "a").when(day < 20, "A").otherwise(F.col("event_type")).alias("name"))


@query(f"with e as ({NAMED}), l as (select *, lag(name) over (partition by user_id order by ts, event_id) old_name from e) select user_id, old_name, name new_name, cast(epoch_us(ts) as bigint) at_us from l where old_name <> name")
def name_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.renames_in(_named(spark, sf_dir), "user_id", "name").select("user_id", "old_name", "new_name", F.unix_micros("changed_at").alias("at_us"))


@query(f"select user_id, name from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) n from ({NAMED})) where n = 1")
def latest_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.latest_name(_named(spark, sf_dir), "user_id", "name")


@query("""with p as (select event_id, case when event_id % 3 = 0 then ['type','created_at','actor','repository','url','payload','repository.id','repository.owner','repository.name','payload.action','payload.number']
  when event_id % 3 = 1 then ['id','type','created_at','actor','repo','payload','extra','actor.id','actor.login','repo.id','repo.name','payload.action','payload.pull_request']
  else ['id','type','created_at','actor','repo','payload','actor.login','repo.id','repo.name','payload.action','payload.pull_request'] end paths, event_id % 3 m from events where event_id % 40 <> 0),
u as (select unnest(paths) path, m from p) select path, cast(count(*) filter (m = 0) as bigint) legacy, cast(count(*) filter (m = 1) as bigint) modern, cast(count(*) filter (m = 2) as bigint) reduced from u group by 1""")
def schema_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which fields the events of each era have, two levels deep."""
    rows = _raw(spark, sf_dir).select((F.col("n") % 3).alias("m"), F.explode(T.json_paths(F.col("raw_json"))).alias("path"))
    return rows.groupBy("path").agg(*[F.count_if(F.col("m") == k).alias(era) for k, era in enumerate(("legacy", "modern", "reduced"))])


@query(f"""with c as ({CANONICAL}), n as ({NAMED}), l as (select user_id, name, lag(name) over (partition by user_id order by ts, event_id) b from n),
k as (select distinct actor_login, case when ends_with(actor_login, '[bot]') then 'suffix' when lower(actor_login) in ('dependabot','github-actions','renovate') then 'known' when regexp_matches(actor_login, '(?i:(bot|automation)$)|(?i:[-_.]ci$)|[a-z0-9]CI$') then 'pattern' else 'none' end k from c),
x as (select * from l where b <> name)
select 'ids' measure, 'total' "key", cast(count(*) as bigint) "value" from c union all select 'ids', 'distinct', cast(count(distinct event_id) as bigint) from c union all select 'ids', 'duplicates', cast(count(*) - count(distinct event_id) as bigint) from c
union all select 'type', event_type, cast(count(*) as bigint) from c group by 2 union all select 'accounts', k, cast(count(*) as bigint) from k group by 2
union all select 'renames', 'changes', cast(count(*) as bigint) from x union all select 'renames', 'entities', cast(count(distinct user_id) as bigint) from x""")
def dataset_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _named(spark, sf_dir).select(F.col("event_id").cast("string").alias("event_id"), "user_id", F.col("name").alias("repo_name"))
    return probes.dataset_profile(canonical(spark, sf_dir).join(names, "event_id"), entity="user_id")


@query("""with l as (select doc_id, unnest(regexp_split_to_array(text, '\\r\\n|[\\n\\r]')) txt, generate_subscripts(regexp_split_to_array(text, '\\r\\n|[\\n\\r]'), 1) n from documents where text is not null),
e as (select doc_id, n, unnest(regexp_extract_all(txt, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}')) m from l)
select doc_id, cast(n as integer) line, 'email' "rule", m "match" from e where not (contains(m, '.dfs.core.windows.net') or contains(m, '.blob.core.windows.net') or contains(m, 'users.noreply.github.com') or contains(m, '@example.com'))
union all select doc_id, cast(n as integer), 'identifier', w from l, (values ('Energeein'), ('the')) i(w) where regexp_matches(txt, '\\b' || w || '\\b')""")
def identity_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.identity_findings(scan(spark, sf_dir, "documents"), ["doc_id"], "text", ["Energeein", "the"])


# ---- features, labels, models


@query(f"""with c as ({CANONICAL}), e as (select distinct repo_id, created_at t, cast(floor(epoch(created_at)) as bigint) s from c), a as (select repo_id, cast(floor(epoch(created_at)) as bigint) s from c),
w as (select repo_id, s, count(*) over (partition by repo_id order by s range between 3600 preceding and 1 preceding) h, count(*) over (partition by repo_id order by s range between 86400 preceding and 1 preceding) d, max(s) over (partition by repo_id order by s range between unbounded preceding and 1 preceding) l from a),
u as (select distinct * from w)
select e.repo_id, cast(epoch_us(e.t) as bigint) at_us, case when l is not null then cast(h as bigint) end events_prior_1h, case when l is not null then cast(d as bigint) end events_prior_24h, cast(e.s - l as double) secs_since_last_event, case when l is not null then round(d / 24.0, 6) end arrival_per_hour_24h from e join u on u.repo_id = e.repo_id and u.s = e.s""")
def stream_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = online.repo_stream_features(canonical(spark, sf_dir))
    return out.select("repo_id", F.unix_micros("event_time").alias("at_us"), "events_prior_1h", "events_prior_24h", "secs_since_last_event", r6(F.col("arrival_per_hour_24h")).alias("arrival_per_hour_24h"))


@query("select user_id, cast(arg_max(event_id, ts) as bigint) event_id, cast(epoch_us(max(ts)) as bigint) at_us from events group by 1")
def online_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published once whole and once by what was added since: the newest row of each key."""
    e = scan(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    store = SnapshotStore(spark, work_folder(spark, "online"))
    served = online.OnlineStore(store).create()
    store.table("features").write(e.where("event_id % 2 = 0"))
    served.publish("features", "served", ["user_id"], "ts")
    store.table("features").append(e.where("event_id % 2 = 1"))
    served.publish("features", "served", ["user_id"], "ts")
    return store.read("served").select("user_id", "event_id", F.unix_micros("ts").alias("at_us"))


@query(f"""{FACT}, b as (select repo_id, pr_number, case when label_exclusion is null then epoch(first_response_at) - epoch(opened_at) > 2592000 else true end breach from fact where label_exclusion is null or label_exclusion = 'closed_no_response')
select b.repo_id, breach, cast(count(*) as bigint) n, cast(sum(case when b.pr_number % 3 = 0 then 2 end) as bigint) "similar", cast(count(f.first_response_at) filter (f.label_exclusion is null) as bigint) responded
from b join fact f on f.repo_id = b.repo_id and f.pr_number = b.pr_number group by 1, 2""")
def label_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fact(spark, sf_dir)
    spine = f.select(*gold.PR)
    similar = spine.where("pr_number % 3 = 0").select(*gold.PR, F.lit(2).alias("similar_resolved_count"), F.lit(0.5).alias("similar_breach_rate"))
    timed = learning.join_label(spine, f).withColumnRenamed("time_to_first_response_seconds", "s")
    rows = learning.join_similarity(learning.join_breach(spine, f, 30 * 86400), similar).join(timed, gold.PR, "left")
    return rows.groupBy("repo_id", "breach").agg(F.count("*").alias("n"), F.sum("similar_resolved_count").alias("similar"), F.count("s").alias("responded"))


@query("select distinct l_orderkey from lineitem where l_orderkey % 7 = 0")
def orphan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = scan(spark, sf_dir, "orders").where("o_orderkey % 7 <> 0").select(F.col("o_orderkey").alias("l_orderkey"))
    return gold.orphans(scan(spark, sf_dir, "lineitem"), parents, "l_orderkey")


@query("select user_id, concat_ws(',', case when min(event_type) filter (day(ts) < 15) is distinct from min(event_type) then 'first_type' end, case when count(*) filter (day(ts) < 15) <> count(*) then 'events' end) moved from events group by 1 having count(*) filter (day(ts) < 15) > 0")
def moved_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = scan(spark, sf_dir, "events")
    at = lambda rows: rows.groupBy("user_id").agg(F.min("event_type").alias("first_type"), F.count("*").alias("events"))
    return features.moved_names(at(e.where(F.dayofmonth("ts") < 15)), at(e), ["user_id"], ["first_type", "events"]).select("user_id", F.concat_ws(",", "moved").alias("moved"))


@query("""with v as (select event_id, unnest([{'f': 'a', 'c': round(value - 50, 6)}, {'f': 'b', 'c': cast(user_id - 30 as double)}, {'f': 'c', 'c': case when event_id % 3 <> 0 then cast(30 - user_id as double) end}]) x from events)
select event_id, cast(row_number() over (partition by event_id order by abs(x.c) desc, x.f) as integer) rank, x.f feature, x.c contribution, case when x.c >= 0 then 'increases_risk' else 'decreases_risk' end direction from v where x.c is not null""")
def contribution_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = F.col("user_id") - 30
    rows = scan(spark, sf_dir, "events").select("event_id", r6(F.col("value") - 50).alias("a"), b.alias("b"), F.when(F.col("event_id") % 3 != 0, -b).alias("c"))
    return learning.ranked_rows(rows, ["event_id"], ["a", "b", "c"])


@query("select event_id, round(0.5 * (value - 40), 6) + 0 \"value\", round(-2.0 * (coalesce(case when user_id % 5 <> 0 then user_id end, 0) - 7), 6) + 0 user_id, round(1 + 0.5 * 40 - 2.0 * 7, 6) baseline from events")
def linear_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = scan(spark, sf_dir, "events").select("event_id", "value", F.when(F.col("user_id") % 5 != 0, F.col("user_id")).alias("user_id"))
    out = learning.contributions(e, 1.0, {"value": 0.5, "user_id": -2.0}, {"value": 40.0, "user_id": 7.0})
    return out.select("event_id", (r6(F.col("value")) + 0).alias("value"), (r6(F.col("user_id")) + 0).alias("user_id"), "baseline")


@query(f"{SCORED}, k as (select repo_id, pr_number, breach_risk, row_number() over (order by breach_risk desc, repo_id, pr_number) rank from pred) select repo_id, pr_number, breach_risk, cast(rank as integer) rank from k where rank <= 200")
def queue_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_folder(spark, "queue")
    backfill.queue_artifact(scored(spark, sf_dir).select("repo_id", "pr_number", "breach_risk"), root)
    return spark.read.parquet(root)


@query("select 'value' feature, cast(count(*) filter (event_id % 4 <> 0) as bigint) non_null, cast(count(*) filter (event_id % 4 = 0) as bigint) \"null\", round(count(*) filter (event_id % 4 = 0) * 100.0 / count(*), 1) pct_null from events union all select 'user_id', cast(count(*) as bigint), cast(0 as bigint), 0.0 from events")
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = scan(spark, sf_dir, "events").select("user_id", F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("value"))
    return probes.coverage_panel(e, ["user_id", "value"])


@query("""with t as (select event_type layer, user_id % 3 k, avg(value) + 1 a, avg(value) filter (event_id % 2 = 0) + 1 b from events group by 1, 2), u as (select layer, k, a / b up from t)
select layer, round(avg(up), 6) mean_speedup, case when min(up) > 1.05 and max(up) / min(up) < 1.5 then 'helped' when max(up) < 0.95 then 'hurt' else 'indeterminate' end verdict from u group by 1""")
def engine_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds by layer of paired runs, played by mean values."""
    e = scan(spark, sf_dir, "events").groupBy("event_type", (F.col("user_id") % 3).alias("k")).agg((F.avg("value") + 1).alias("a"), (F.avg(F.when(F.col("event_id") % 2 == 0, F.col("value"))) + 1).alias("b")).collect()
    runs = [({r["event_type"]: r["a"] for r in e if r["k"] == k}, {r["event_type"]: r["b"] for r in e if r["k"] == k}) for k in range(3)]
    found = backfill.compare_engines([a for a, _ in runs], [b for _, b in runs])
    return spark.createDataFrame([(layer, round(x["mean"], 6), x["verdict"]) for layer, x in found.items()], "layer string, mean_speedup double, verdict string")


# ---- retrieval, samples, streams, tools


@query("select event_id, event_type from (select event_id, event_type, row_number() over (order by value, event_id) - 1 n from events) where n >= 3 and (n - 3) % 10 = 0")
def every_tenth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.every_nth(scan(spark, sf_dir, "events"), 10, ["value", "event_id"], 3).select("event_id", "event_type")


@query("select 'pr:1:' || event_id entity_key, cast(floor(epoch(ts)) as bigint) at_s, 64 dims, 1.0 norm from events order by ts, 'pr:1:' || event_id limit 500")
def first_encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earliest 500 texts, encoded."""
    e = scan(spark, sf_dir, "events")
    text = F.concat_ws(" ", "event_type", "user_id", "event_id")
    texts = e.select(F.concat(F.lit("pr:1:"), "event_id").alias("entity_key"), F.col("ts").alias("event_time"), F.sha2(text, 256).alias("text_hash"), text.alias("text"))
    out = retrieval.embed(texts, retrieval.hashing_encoder, limit=500)
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))
    return out.select("entity_key", secs("event_time").alias("at_s"), F.size("embedding").alias("dims"), F.round(norm, 6).alias("norm"))


@query("""with q as (select vec_id, embedding x from embeddings where vec_id in (100, 200, 300, 400)), m as (select q.vec_id pr_number, e.vec_id o, list_distance(cast(x as double[]), cast(embedding as double[])) d from q join embeddings e on e.vec_id <> q.vec_id and e.vec_id < q.vec_id + 50),
r as (select *, row_number() over (partition by pr_number order by d, 'pr:1:' || o) n from m) select pr_number, 'pr:1:' || o entity_key, round(d, 6) distance, cast(n as integer) rank from r where n <= 10""")
def similar_pull_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tool's answers to four requests, and a refusal that answers nothing."""
    v = scan(spark, sf_dir, "embeddings")
    store = SnapshotStore(spark, work_folder(spark, "tools"))
    rows = v.select(F.concat(F.lit("pr:1:"), "vec_id").alias("entity_key"), F.timestamp_seconds("vec_id").alias("event_time"), F.col("embedding").cast("array<double>").alias("embedding"))
    store.table("embeddings").write(rows)
    tools, out = Tools(spark, scan(spark, sf_dir, "events"), store), []
    for number in (100, 200, 300, 400, 10**12):
        answer = tools.similar_prs(Request(1, number, datetime.fromtimestamp(number % 10**9 + 50, UTC)))
        out += [(number, n["entity_key"], round(n["distance"], 6), n["rank"]) for n in answer.get("neighbours", [])]
    return spark.createDataFrame(out, "pr_number long, entity_key string, distance double, rank int")


@query("select event_id, event_id % 3 <> 2 grounded from events")
def grounded_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers that round, cut off or misstate a score."""
    v, k = F.col("value") + 10, F.col("event_id") % 3
    said = F.when(k == 0, F.format_string("%.2f", v)).when(k == 1, F.format_string("%.2f", F.floor(F.round(v * 100, 6)) / 100)).otherwise(F.format_string("%.2f", v + 1))

    def judge(frames):
        for f in frames:
            good = [grounding.check(f"The score is {s}.", [("predict", {"breach_risk": x})]).grounded for s, x in zip(f["said"], f["v"])]
            yield pd.DataFrame({"event_id": f["event_id"], "grounded": good})

    return scan(spark, sf_dir, "events").select("event_id", v.alias("v"), said.alias("said")).mapInPandas(judge, "event_id long, grounded boolean")


@query("select cast(count(*) as bigint) total, cast(count(*) filter (event_id % 5 = 0) as bigint) late_count, cast(count(*) as bigint) non_reduced_count, cast(count(*) as bigint) landed from events")
def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream observed of its batches, and what it landed."""
    e = scan(spark, sf_dir, "events")
    root, form = work_folder(spark, "metrics"), "yyyy-MM-dd'T'HH:mm:ss'Z'"
    event = F.concat(F.lit('{"id":"'), F.col("event_id"), F.lit('","type":"PushEvent","created_at":"'), F.date_format("ts", form), F.lit('","actor":"u","repo":{"id":'), F.col("user_id"), F.lit("}}"))
    polled = F.col("ts") + F.when(F.col("event_id") % 5 == 0, F.expr("interval 20 minutes")).otherwise(F.expr("interval 5 minutes"))
    e.select(F.date_format(polled, form).alias("polled_at"), event.alias("event")).repartition(3).write.json(f"{root}/landing")
    stream = ingest.write_stream(ingest.stream_events(spark, f"{root}/landing", max_files=1), f"{root}/silver", f"{root}/checkpoint")
    stream.awaitTermination()
    seen = ingest.observed(stream)
    landed = ingest.read_silver(spark, f"{root}/silver").count()
    return spark.createDataFrame([(seen["total"], seen["late_count"], seen["non_reduced_count"], landed)], "total long, late_count long, non_reduced_count long, landed long")
