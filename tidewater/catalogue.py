"""All queries of the engine with their oracle SQL, by name.

The event domain is played by two of the tables: ``events`` (an actor's events)
and ``orders`` with ``lineitem`` (pull requests with their responses).
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .functions.payloads import normalize_events, parse_events
from .operators import cleaning, drift, learning, lineage, retrieval
from .operators.asof import as_of_join, rolling
from .plans import features, gold, reports
from .sources.snapshots import Contract
from .sources.tables import scan, work_folder
from .streaming.online import latest_per_key

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def secs(column: str):
    return F.unix_timestamp(F.col(column))


def r6(column) -> F.Column:
    return F.round(column, 6)


# ---- the tables as events

#: Day and month of an ingestion an hour after each event; every 50th an hour before it.
BOTS = "case when user_id % 10 = 0 then concat('robot', user_id, '[bot]') when user_id % 10 = 1 then concat('Build', user_id, 'CI') when user_id % 10 = 2 then 'Dependabot' when user_id % 10 = 3 then concat('team', user_id, '-ci') else concat('user', user_id) end"


def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` in canonical columns: a purchase opens, an error ends."""
    e = scan(spark, sf_dir, "events")
    kind = F.when(F.col("event_type").isin("purchase", "error"), "PullRequestEvent").when(F.col("event_type") == "click", "PushEvent").when(F.col("event_type") == "signup", "IssuesEvent").otherwise("IssueCommentEvent")
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.expr(BOTS).alias("actor_login"),
        F.col("ts").alias("created_at"),
        (F.col("user_id") % 20).alias("repo_id"),
        kind.alias("event_type"),
        F.when(F.col("event_type") == "purchase", "opened").when(F.col("event_type") == "error", "closed").when(F.col("event_type") == "signup", "opened").alias("event_action"),
        (F.col("user_id") * 1000 + F.get_json_object("props", "$.k").cast("long")).alias("pr_number"),
        F.when(F.col("event_type") == "error", F.when(F.col("event_id") % 7 != 0, F.col("value") > 20)).alias("pr_merged"),
        (F.col("event_id") % 5 == 0).alias("pr_draft"),
        F.floor("value").cast("long").alias("push_size"),
        (F.floor("value") - 1).cast("long").alias("push_distinct_size"),
        (F.col("ts") + F.when(F.col("event_id") % 50 == 0, F.expr("interval -1 hour")).otherwise(F.expr("interval 1 hour"))).alias("ingested_at"),
    )


CANONICAL = f"""
select cast(event_id as varchar) event_id, {BOTS} actor_login, ts created_at, user_id % 20 repo_id,
  case when event_type in ('purchase','error') then 'PullRequestEvent' when event_type = 'click' then 'PushEvent' when event_type = 'signup' then 'IssuesEvent' else 'IssueCommentEvent' end event_type,
  case when event_type = 'purchase' then 'opened' when event_type = 'error' then 'closed' when event_type = 'signup' then 'opened' end event_action,
  user_id * 1000 + cast(json_extract_string(props, '$.k') as bigint) pr_number,
  case when event_type = 'error' then case when event_id % 7 <> 0 then value > 20 end end pr_merged,
  event_id % 5 = 0 pr_draft, cast(floor(value) as bigint) push_size, cast(floor(value) - 1 as bigint) push_distinct_size,
  case when event_id % 50 = 0 then ts - interval 1 hour else ts + interval 1 hour end ingested_at
from events"""

IS_BOT = "(ends_with({0}, '[bot]') or lower({0}) in ('dependabot','github-actions','renovate') or regexp_matches({0}, '(?i:(bot|automation)$)|(?i:[-_.]ci$)|[a-z0-9]CI$'))"


def life(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as pull requests: opened by the customer, answered by the
    suppliers of its lines, closed with its last line if its status is F."""
    o = scan(spark, sf_dir, "orders").join(scan(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    li = scan(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_shipdate")
    pr = [F.col("c_nationkey").cast("long").alias("repo_id"), F.col("o_orderkey").alias("pr_number")]
    author = F.when(F.col("o_custkey") % 97 != 0, F.col("o_custkey").cast("string"))
    nothing = F.lit(None)
    opens = o.select(*pr, F.lit("opened").alias("kind"), F.when(F.col("o_orderkey") % 101 != 0, F.col("o_orderdate")).alias("at"), author.alias("actor_login"), (F.col("o_orderstatus") == "P").alias("draft"), nothing.cast("boolean").alias("merged"), F.col("o_orderdate").alias("ingested_at"))
    lines = o.join(li, F.col("o_orderkey") == F.col("l_orderkey"))
    kind = F.when(F.col("l_linenumber") == 1, "review").when(F.col("l_linenumber") == 2, "review_comment").otherwise("issue_comment")
    said = lines.select(*pr, kind.alias("kind"), F.col("l_shipdate").alias("at"), F.col("l_suppkey").cast("string").alias("actor_login"), nothing.cast("boolean").alias("draft"), nothing.cast("boolean").alias("merged"), F.col("l_shipdate").alias("ingested_at"))
    ends = lines.where("o_orderstatus = 'F'").groupBy(*pr).agg(F.max("l_shipdate").alias("at"), F.first(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias("merged"))
    ends = ends.select("repo_id", "pr_number", F.lit("closed").alias("kind"), "at", nothing.cast("string").alias("actor_login"), nothing.cast("boolean").alias("draft"), "merged", F.col("at").alias("ingested_at"))
    return opens.unionByName(said).unionByName(ends)


LIFE = """
select cast(c_nationkey as bigint) repo_id, o_orderkey pr_number, 'opened' kind, case when o_orderkey % 101 <> 0 then o_orderdate end at_,
  case when o_custkey % 97 <> 0 then cast(o_custkey as varchar) end actor, o_orderstatus = 'P' draft, cast(null as boolean) merged, o_orderdate ingested_at
from orders join customer on o_custkey = c_custkey
union all
select cast(c_nationkey as bigint), o_orderkey, case l_linenumber when 1 then 'review' when 2 then 'review_comment' else 'issue_comment' end, l_shipdate, cast(l_suppkey as varchar), null, null, l_shipdate
from orders join customer on o_custkey = c_custkey join lineitem on l_orderkey = o_orderkey
union all
select cast(c_nationkey as bigint), o_orderkey, 'closed', max(l_shipdate), null, null, bool_or(o_orderpriority in ('1-URGENT','2-HIGH')), max(l_shipdate)
from orders join customer on o_custkey = c_custkey join lineitem on l_orderkey = o_orderkey where o_orderstatus = 'F' group by 1, 2"""

FACT = f"""
with life as ({LIFE}),
o as (select repo_id, pr_number, at_ opened_at, actor author_login, draft is_draft from life where kind = 'opened'),
c as (select repo_id, pr_number, at_ closed_at, merged from life where kind = 'closed'),
r as (select l.repo_id, l.pr_number, min(case when kind = 'review' then at_ end) first_review_at,
        min(case when l.actor <> o.author_login and at_ >= opened_at then at_ end) first_response_at
      from life l join o on o.repo_id = l.repo_id and o.pr_number = l.pr_number
      where kind in ('review','review_comment','issue_comment') group by 1, 2),
m as (select repo_id, pr_number, max(ingested_at) last_ingested_at from life group by 1, 2),
j as (select o.repo_id, o.pr_number, author_login, is_draft, opened_at, closed_at, merged, first_review_at, first_response_at, last_ingested_at
      from o left join c on c.repo_id = o.repo_id and c.pr_number = o.pr_number
      left join r on r.repo_id = o.repo_id and r.pr_number = o.pr_number
      join m on m.repo_id = o.repo_id and m.pr_number = o.pr_number),
fact as (select *, {IS_BOT.format('author_login')} author_is_bot,
  case when author_login is null then 'author_unobserved' when is_draft then 'draft' when opened_at is null then 'open_unobserved'
       when first_response_at is null and closed_at is null then 'right_censored' when first_response_at is null then 'closed_no_response' end label_exclusion,
  closed_at is null is_censored from j)"""

FACT_COLUMNS = """repo_id, pr_number, author_login, author_is_bot, is_draft, cast(epoch(opened_at) as bigint) opened_at, cast(epoch(closed_at) as bigint) closed_at, merged,
  cast(epoch(first_review_at) as bigint) first_review_at, cast(epoch(first_response_at) as bigint) first_response_at,
  case when label_exclusion is null then cast(epoch(first_response_at) - epoch(opened_at) as bigint) end time_to_first_response_seconds, is_censored, label_exclusion"""


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_pull_request(life(spark, sf_dir))


def as_epochs(df: DataFrame) -> DataFrame:
    times = ("opened_at", "closed_at", "first_review_at", "first_response_at")
    return df.select(*[secs(c).alias(c) if c in times else F.col(c) for c in df.columns if c != "last_ingested_at"])


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions from a fixed score of the order price."""
    prices = scan(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pr_number"), F.round(F.col("o_totalprice") % 1000 / 1000, 3).alias("breach_risk"))
    f = fact(spark, sf_dir)
    labels = learning.breach_labels(f, 30 * 86400)
    return f.join(labels, gold.PR).join(prices, "pr_number").select("repo_id", "pr_number", "breach_risk", "breach", (F.col("pr_number") % 4 == 0).alias("is_bot_author"))


SCORED = (
    FACT
    + """, pred as (select repo_id, pr_number, round(o_totalprice % 1000 / 1000, 3) breach_risk,
  case when label_exclusion is null then epoch(first_response_at) - epoch(opened_at) > 2592000 else true end breach, pr_number % 4 = 0 is_bot_author
  from fact join orders on o_orderkey = pr_number where label_exclusion is null or label_exclusion = 'closed_no_response')"""
)


# ---- point in time


@query("""
with a as (select user_id, ts, event_id, count(*) over w n, sum(case when event_type = 'error' then 1 else 0 end) over w e
           from events window w as (partition by user_id order by ts range between unbounded preceding and current row)),
f as (select distinct user_id, ts, n, e from a),
s as (select event_id, user_id, ts from events where event_type = 'purchase')
select s.event_id, s.user_id, cast(floor(epoch(s.ts)) as bigint) as_of, cast(f.n as bigint) events_to_date, cast(f.e as bigint) errors_to_date, round(f.e / f.n, 6) error_share
from s asof left join f on s.user_id = f.user_id and s.ts > f.ts""")
def asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = scan(spark, sf_dir, "events")
    from .operators.asof import running

    log = running(e, ["user_id"], "ts", events_to_date=F.lit(1), errors_to_date=(F.col("event_type") == "error").cast("int"))
    spine = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    out = as_of_join(spine, log.withColumnRenamed("ts", "known_at"), ["user_id"], "ts", "known_at")
    return out.select("event_id", "user_id", F.floor(secs("ts")).alias("as_of"), "events_to_date", "errors_to_date", r6(F.col("errors_to_date") / F.col("events_to_date")).alias("error_share"))


REPO_ACTIVITY = f"""
select distinct repo_id, event_time, cast(count(*) over w as bigint) events_total_to_date, cast(sum(case when {IS_BOT.format('actor_login')} then 1 else 0 end) over w as bigint) bot_events_to_date,
  cast(sum(case when event_type = 'PullRequestEvent' and event_action = 'opened' then 1 else 0 end) over w as bigint) prs_opened_to_date
from (select *, created_at event_time from c) window w as (partition by repo_id order by event_time range between unbounded preceding and current row)"""
AUTHOR_ACTIVITY = """
with op as (select repo_id, pr_number, actor_login, created_at, row_number() over (partition by repo_id, pr_number order by created_at, event_id) n from c where event_type = 'PullRequestEvent' and event_action = 'opened'),
o as (select repo_id, pr_number, actor_login author_login, created_at opened_at from op where n = 1),
x as (select repo_id, pr_number, min(created_at) closed_at, arg_min(case when pr_merged is null then 2 when pr_merged then 1 else 0 end, created_at) m from c where event_type = 'PullRequestEvent' and event_action = 'closed' group by 1, 2),
d as (select author_login, closed_at, m from o join x using (repo_id, pr_number))
select q.author_login, q.opened_at, count(d.closed_at) prior_pr_count, sum(case when m = 1 then 1 else 0 end) won, sum(case when m < 2 then 1 else 0 end) known
from (select distinct author_login, opened_at from o) q left join d on d.author_login = q.author_login and d.closed_at < q.opened_at group by 1, 2"""


@query(f"with c as ({CANONICAL}) select repo_id, cast(epoch_us(event_time) as bigint) at_us, events_total_to_date, bot_events_to_date, prs_opened_to_date, round(bot_events_to_date / events_total_to_date, 6) bot_share_to_date from ({REPO_ACTIVITY})")
def repo_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.repo_activity(canonical(spark, sf_dir)).select("repo_id", F.unix_micros("event_time").alias("at_us"), "events_total_to_date", "bot_events_to_date", "prs_opened_to_date", r6(F.col("bot_share_to_date")).alias("bot_share_to_date"))


@query(f"with c as ({CANONICAL}), a as ({AUTHOR_ACTIVITY}) select author_login, cast(epoch_us(opened_at) as bigint) at_us, cast(prior_pr_count as bigint) prior_pr_count, case when known > 0 then round(won / known, 6) end prior_merge_rate from a")
def author_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.author_activity(canonical(spark, sf_dir)).select("author_login", F.unix_micros("event_time").alias("at_us"), "prior_pr_count", r6(F.col("prior_merge_rate")).alias("prior_merge_rate"))


SPINE = "select repo_id, pr_number, actor_login author_login, created_at as_of, pr_draft from (select *, row_number() over (partition by repo_id, pr_number order by created_at, event_id) n from c where event_type = 'PullRequestEvent' and event_action = 'opened') where n = 1"


@query(f"with c as ({CANONICAL}) select repo_id, pr_number, author_login, cast(epoch_us(as_of) as bigint) as_of_us from ({SPINE})")
def pr_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.pr_spine(canonical(spark, sf_dir)).select("repo_id", "pr_number", "author_login", F.unix_micros("as_of_timestamp").alias("as_of_us"))


@query(f"with c as ({CANONICAL}), s as ({SPINE}) select repo_id, pr_number, pr_draft is_draft, {IS_BOT.format('author_login')} is_bot_author, cast(dayofweek(as_of) + 1 as integer) opened_day_of_week, cast(hour(as_of) as integer) opened_hour from s")
def pr_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.pr_static(canonical(spark, sf_dir))


@query(f"""with c as ({CANONICAL}), s as ({SPINE}), a as ({AUTHOR_ACTIVITY}), r as ({REPO_ACTIVITY})
select s.repo_id, s.pr_number, s.author_login, cast(epoch_us(s.as_of) as bigint) as_of_us, cast(a.prior_pr_count as bigint) prior_pr_count, case when a.known > 0 then round(a.won / a.known, 6) end prior_merge_rate,
  r.events_total_to_date, r.bot_events_to_date, r.prs_opened_to_date, s.pr_draft is_draft, {IS_BOT.format('s.author_login')} is_bot_author
from s left join a on a.author_login = s.author_login and a.opened_at = s.as_of asof left join r on r.repo_id = s.repo_id and s.as_of > r.event_time""")
def asof_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = canonical(spark, sf_dir)
    out = features.assemble(features.pr_spine(c), features.author_activity(c), features.repo_activity(c), features.pr_static(c))
    return out.select("repo_id", "pr_number", "author_login", F.unix_micros("as_of_timestamp").alias("as_of_us"), "prior_pr_count", r6(F.col("prior_merge_rate")).alias("prior_merge_rate"), "events_total_to_date", "bot_events_to_date", "prs_opened_to_date", "is_draft", "is_bot_author")


@query("""with e as (select event_id, user_id, cast(floor(epoch(ts)) as bigint) s from events),
w as (select event_id, user_id, s, count(*) over (partition by user_id order by s range between 3600 preceding and 1 preceding) h,
  count(*) over (partition by user_id order by s range between 86400 preceding and 1 preceding) d,
  max(s) over (partition by user_id order by s range between unbounded preceding and 1 preceding) l from e)
select event_id, user_id, case when l is not null then cast(h as bigint) end events_prior_1h, case when l is not null then cast(d as bigint) end events_prior_24h,
  cast(s - l as double) secs_since_last_event, case when l is not null then round(d / 24.0, 6) end arrival_per_hour_24h from w""")
def rolling_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rolling(scan(spark, sf_dir, "events"), "user_id", "ts")
    return out.select("event_id", "user_id", "events_prior_1h", "events_prior_24h", "secs_since_last_event", r6(F.col("arrival_per_hour_24h")).alias("arrival_per_hour_24h"))


# ---- cleaning

REPEATED = "select event_id, user_id, ts, 0 copy from events union all select event_id, user_id, ts + interval 5 minute, 1 from events where day(ts) = 7 union all select event_id, user_id, ts, 2 from events where day(ts) = 8 union all select null, user_id, ts, 3 from events where hour(ts) = 3"


def _repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = scan(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return (
        e.withColumn("copy", F.lit(0))
        .unionByName(e.where(F.dayofmonth("ts") == 7).select("event_id", "user_id", (F.col("ts") + F.expr("interval 5 minute")).alias("ts"), F.lit(1).alias("copy")))
        .unionByName(e.where(F.dayofmonth("ts") == 8).withColumn("copy", F.lit(2)))
        .unionByName(e.where(F.hour("ts") == 3).select(F.lit(None).cast("long").alias("event_id"), "user_id", "ts", F.lit(3).alias("copy")))
    )


@query(f"with d as ({REPEATED}) select event_id, user_id, cast(epoch_us(ts) as bigint) at_us, cast(copy as integer) \"copy\" from (select *, row_number() over (partition by event_id order by ts, copy) n from d where event_id is not null) where n = 1 union all select event_id, user_id, cast(epoch_us(ts) as bigint), cast(copy as integer) from d where event_id is null")
def dedup_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.deduplicate(_repeated(spark, sf_dir), order=("ts", "copy")).select("event_id", "user_id", F.unix_micros("ts").alias("at_us"), "copy")


@query(f"with d as ({REPEATED}) select cast(count(*) as bigint) total, cast(count(distinct event_id) as bigint) \"distinct\", cast(count(*) - count(distinct event_id) as bigint) duplicates from d where event_id is not null")
def duplicate_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.duplicate_stats(_repeated(spark, sf_dir))


@query("select event_id, sha256(concat_ws('|', coalesce(cast(nullif(event_type, 'view') as varchar), '\\N'), cast(user_id as varchar), cast(cast(floor(epoch(ts)) as bigint) as varchar))) key from events")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, sf_dir, "events").select("event_id", T.content_key(F.nullif(F.col("event_type"), F.lit("view")), F.col("user_id"), secs("ts")).alias("key"))


@query(f"with c as ({CANONICAL}) select actor_login, {IS_BOT.format('actor_login')} is_bot, cast(count(*) as bigint) events from c group by 1, 2")
def bot_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical(spark, sf_dir).groupBy("actor_login", T.is_bot(F.col("actor_login")).alias("is_bot")).agg(F.count("*").alias("events"))


#: One raw event for each row, its shape by era, every 40th broken.
def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = scan(spark, sf_dir, "events")
    at = F.date_format("ts", "MM-dd'T'HH:mm:ss")
    i, u = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    k = F.get_json_object("props", "$.k")
    legacy = F.concat(F.lit('{"type":"PullRequestEvent","created_at":"2013-'), at, F.lit('-07:00","actor":"dev'), u, F.lit('","repository":{"id":'), u, F.lit(',"owner":"own","name":"r'), u, F.lit('"},"url":"http://x/'), i, F.lit('","payload":{"action":"opened","number":'), k, F.lit("}}"))
    modern = F.concat(F.lit('{"id":"'), i, F.lit('","type":"PullRequestEvent","created_at":"2020-'), at, F.lit('Z","actor":{"id":7,"login":"dev'), u, F.lit('"},"repo":{"id":'), u, F.lit(',"name":"own/r'), u, F.lit('"},"payload":{"action":"closed","pull_request":{"number":'), k, F.lit(',"merged":true,"draft":false}},"extra":[1]}'))
    reduced = F.concat(F.lit('{"id":"'), i, F.lit('","type":"PullRequestEvent","created_at":"2025-11-'), F.date_format("ts", "dd'T'HH:mm:ss"), F.lit('Z","actor":{"login":"dev'), u, F.lit('"},"repo":{"id":'), u, F.lit(',"name":"own/r'), u, F.lit('"},"payload":{"action":"merged","pull_request":{"number":'), k, F.lit("}}}"))
    m = F.col("event_id") % 3
    raw = F.when(F.col("event_id") % 40 == 0, F.lit("{not json")).when(m == 0, legacy).when(m == 1, modern).otherwise(reduced)
    return e.select(raw.alias("raw_json"), F.lit(datetime(2026, 1, 1, tzinfo=UTC)).alias("ingested_at"), F.col("event_id").alias("n"), F.lit("d").alias("event_date"), F.lit(0).alias("event_hour"))


@query("""select event_id n, case when event_id % 40 = 0 then null else 'dev' || user_id end actor_login, case when event_id % 40 <> 0 then user_id end repo_id,
  case when event_id % 40 <> 0 then 'own/r' || user_id end repo_name, case when event_id % 40 <> 0 then cast(json_extract_string(props, '$.k') as bigint) end pr_number,
  case when event_id % 40 <> 0 and event_id % 3 > 0 then true end pr_merged, case when event_id % 40 <> 0 and event_id % 3 = 1 then false end pr_draft from events""")
def parse_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_events(_raw(spark, sf_dir)).select("n", "actor_login", "repo_id", "repo_name", "pr_number", "pr_merged", "pr_draft")


@query("""select case when event_id % 40 = 0 then null when event_id % 3 = 0 then 'legacy_v1' when event_id % 3 = 1 then 'modern_v2' else 'reduced_v3' end schema_era,
  case when event_id % 40 = 0 or event_id % 3 = 0 then 'content_hash' else 'native' end event_id_source, event_id % 40 = 0 no_id, cast(count(*) as bigint) events from events group by 1, 2, 3""")
def normalize_era(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalize_events(parse_events(_raw(spark, sf_dir)))
    return rows.groupBy("schema_era", "event_id_source", F.col("event_id").isNull().alias("no_id")).agg(F.count("*").alias("events"))


DIRTY = f"select case when cast(event_id as bigint) % 11 = 0 then '' when cast(event_id as bigint) % 13 = 0 then null else event_id end event_id, actor_login, case when cast(event_id as bigint) % 17 <> 0 then created_at end created_at, case when cast(event_id as bigint) % 19 <> 0 then repo_id end repo_id, event_type, ingested_at, event_id n from ({CANONICAL})"
FAILED = """array_to_string(list_filter([case when not coalesce(event_id is not null and length(event_id) > 0, false) then 'event_id_present' end, case when created_at is null then 'created_at_present' end,
 case when not coalesce(created_at <= ingested_at, false) then 'created_at_not_future' end, case when repo_id is null then 'repo_id_present' end, case when event_type is null then 'event_type_present' end], lambda x: x is not null), ',')"""


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, i = canonical(spark, sf_dir), F.col("event_id").cast("long")
    return c.select(
        F.when(i % 11 == 0, F.lit("")).when(i % 13 != 0, F.col("event_id")).alias("event_id"),
        "actor_login",
        F.when(i % 17 != 0, F.col("created_at")).alias("created_at"),
        F.when(i % 19 != 0, F.col("repo_id")).alias("repo_id"),
        "event_type",
        "ingested_at",
        F.col("event_id").alias("n"),
    )


@query(f"with d as ({DIRTY}), f as (select n, {FAILED} failed from d) select n, failed, failed = '' clean from f")
def quality_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean, bad = cleaning.split(cleaning.apply_rules(_dirty(spark, sf_dir)))
    return clean.select("n", F.lit("").alias("failed"), F.lit(True).alias("clean")).unionByName(bad.select("n", F.concat_ws(",", cleaning.FAILED).alias("failed"), F.lit(False).alias("clean")))


@query(f"with d as ({DIRTY}), f as (select {FAILED} failed from d) select 'ALL RULES (total quarantined)' \"rule\", cast(count(*) as bigint) rows_failed from f where failed <> '' union all select r, cast(count(*) as bigint) from (select unnest(string_split(failed, ',')) r from f where failed <> '') group by 1")
def quarantine_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.quarantine_by_rule(cleaning.apply_rules(_dirty(spark, sf_dir)))


@query(f"""with c as ({CANONICAL}), a as (select count(distinct date_trunc('hour', created_at)) as hours, count(*) t, sum(case when event_type = 'PullRequestEvent' and event_action = 'opened' then 1 else 0 end) o,
  sum(case when event_type = 'PullRequestEvent' then 1 else 0 end) p, sum(case when event_type = 'IssueCommentEvent' then 1 else 0 end) r, bool_or(event_type = 'PullRequestEvent' and pr_draft is not null) d from c)
select cast(hours as bigint) as hours, cast(t as bigint) total_events, cast(o as bigint) opened_prs, d carries_draft, round(p / t, 6) pull_request_share, round(r / t, 6) response_share,
 array_to_string(list_filter([case when p / t < 0.03 then 'pull_request_share' end, case when r / t < 0.03 then 'review_signal_share' end, case when o < 1000 then 'opened_prs' end], lambda x: x is not null), ',') failed_rules from a""")
def window_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cleaning.window_profile(canonical(spark, sf_dir))
    return out.select("hours", "total_events", "opened_prs", "carries_draft", r6(F.col("pull_request_share")).alias("pull_request_share"), r6(F.col("response_share")).alias("response_share"), F.concat_ws(",", "failed_rules").alias("failed_rules"))


@query("""with h as (select unnest(generate_series(timestamp '2024-01-01 00:00:00', timestamp '2024-02-02 23:00:00', interval 1 hour)) hour_)
select cast(epoch(hour_) as bigint) missing from h where hour_ not in (select distinct date_trunc('hour', ts) from events where event_type = 'error' and value > 20)""")
def gap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    present = scan(spark, sf_dir, "events").where("event_type = 'error' and value > 20").select(F.date_trunc("hour", "ts").alias("hour"))
    expected = cleaning.expected_hours(spark, datetime(2024, 1, 1, tzinfo=UTC), datetime(2024, 2, 2, 23, tzinfo=UTC))
    return cleaning.missing_hours(expected, present).select(secs("hour").alias("missing"))


# ---- gold


@query(f"with c as ({CANONICAL}), k as (select *, case when event_type = 'PullRequestEvent' and event_action = 'opened' then 'opened' when event_type = 'PullRequestEvent' and event_action in ('closed','merged') then 'closed' when event_type = 'IssueCommentEvent' then 'issue_comment' end kind from c) select repo_id, kind, cast(count(*) as bigint) events from k where kind in ('opened','closed') or kind = 'issue_comment' and (repo_id, pr_number) in (select (repo_id, pr_number) from k where kind in ('opened','closed')) group by 1, 2")
def pr_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gold.pr_events(canonical(spark, sf_dir).withColumn("is_pr_comment", F.lit(None).cast("boolean")))
    return rows.groupBy("repo_id", "kind").agg(F.count("*").alias("events"))


@query(f"{FACT} select {FACT_COLUMNS} from fact")
def fact_pr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_epochs(fact(spark, sf_dir))


@query(f"{FACT} select {FACT_COLUMNS} from fact")
def fact_pr_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Built up to a day, then brought up to date by what came since."""
    day = datetime(1999, 1, 1, tzinfo=UTC)
    events = life(spark, sf_dir)
    prior = gold.fact_pull_request(events.where(F.col("ingested_at") < F.lit(day)))
    return as_epochs(gold.fact_incremental(prior, events, day))


@query(f"{FACT} select repo_id, pr_number, case when label_exclusion is null then epoch(first_response_at) - epoch(opened_at) > 2592000 else true end breach from fact where label_exclusion is null or label_exclusion = 'closed_no_response'")
def label_breach(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learning.breach_labels(fact(spark, sf_dir), 30 * 86400)


#: The fact table with rows broken by their numbers, and its first rows twice.
BROKEN = f"""{FACT}, b as (select case when pr_number % 13 <> 0 then repo_id end repo_id, pr_number, opened_at, closed_at,
  case when pr_number % 17 = 0 then opened_at - interval 1 day else first_response_at end first_response_at,
  case when pr_number % 19 = 0 then 1 when label_exclusion is null then epoch(first_response_at) - epoch(opened_at) end secs_,
  case when pr_number % 23 = 0 then 'unheard_of' else label_exclusion end label_exclusion, case when pr_number % 29 = 0 then not is_censored else is_censored end is_censored from fact),
  t as (select * from b union all select * from b where pr_number % 31 = 0)"""


@query(f"""{BROKEN} select * from (
  select 'censored_iff_open' "check", cast(count(*) filter (is_censored <> (closed_at is null)) as bigint) violations from t union all
  select 'grain', cast(count(*) - count(distinct (coalesce(repo_id, -1), pr_number)) as bigint) from t union all
  select 'key_not_null', cast(count(*) filter (repo_id is null) as bigint) from t union all
  select 'known_exclusion', cast(count(*) filter (label_exclusion = 'unheard_of') as bigint) from t union all
  select 'label_xor_exclusion', cast(count(*) filter ((secs_ is not null) = (label_exclusion is not null)) as bigint) from t union all
  select 'response_not_before_open', cast(count(*) filter (first_response_at < opened_at) as bigint) from t)""")
def fact_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, n = fact(spark, sf_dir), F.col("pr_number")
    f = f.withColumns({
        "repo_id": F.when(n % 13 != 0, F.col("repo_id")),
        "first_response_at": F.when(n % 17 == 0, F.col("opened_at") - F.expr("interval 1 day")).otherwise(F.col("first_response_at")),
        "time_to_first_response_seconds": F.when(n % 19 == 0, 1).otherwise(F.col("time_to_first_response_seconds")),
        "label_exclusion": F.when(n % 23 == 0, "unheard_of").otherwise(F.col("label_exclusion")),
        "is_censored": F.when(n % 29 == 0, ~F.col("is_censored")).otherwise(F.col("is_censored")),
    })
    return gold.fact_violations(f.unionByName(f.where(n % 31 == 0)))


DAILY = f"""select repo_id, cast(created_at as date) activity_date, cast(count(*) as bigint) events_total, cast(count(*) filter ({IS_BOT.format('actor_login')}) as bigint) bot_events,
 cast(count(*) filter (event_type = 'PullRequestEvent' and event_action = 'opened') as bigint) prs_opened, cast(count(*) filter (event_type = 'PullRequestEvent' and event_action in ('closed','merged')) as bigint) prs_closed,
 cast(count(*) filter (event_type = 'IssuesEvent' and event_action = 'opened') as bigint) issues_opened, cast(count(*) filter (event_type = 'IssueCommentEvent') as bigint) comments, cast(count(*) filter (event_type = 'PushEvent') as bigint) pushes,
 cast(sum(case when event_type = 'PushEvent' then push_size end) as bigint) commits_pushed, cast(sum(case when event_type = 'PushEvent' then push_distinct_size end) as bigint) distinct_commits_pushed from c group by 1, 2"""


@query(f"with c as ({CANONICAL}) select * replace (cast(activity_date as varchar) as activity_date) from ({DAILY})")
def agg_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.agg_repo_daily(canonical(spark, sf_dir)).drop("last_ingested_at").withColumn("activity_date", F.col("activity_date").cast("string"))


@query("""with e as (select user_id, ts, event_id, case when day(ts) < 10 then 'a' when day(ts) < 20 then 'A' else event_type end name from events),
c as (select *, lag(name) over (partition by user_id order by ts, event_id) b from e), d as (select * from c where b is null or b <> name)
select user_id, name, cast(epoch_us(ts) as bigint) valid_from, cast(epoch_us(lead(ts) over (partition by user_id order by ts, event_id)) as bigint) valid_to from d""")
def scd2_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.dayofmonth("ts")
    e = scan(spark, sf_dir, "events").withColumn("name", F.when(day < 10, "a").when(day < 20, "A").otherwise(F.col("event_type")))
    out = gold.name_history(e, "user_id", "name", "ts")
    return out.select("user_id", "name", F.unix_micros("valid_from").alias("valid_from"), F.unix_micros("valid_to").alias("valid_to"))


@query("select user_id, cast(arg_max(event_id, ts) as bigint) event_id, arg_max(event_type, ts) event_type, cast(epoch_us(max(ts)) as bigint) at_us from events group by 1")
def latest_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latest_per_key(scan(spark, sf_dir, "events"), ["user_id"], "ts")
    return rows.select("user_id", "event_id", "event_type", F.unix_micros("ts").alias("at_us"))


# ---- reports


@query(f"""{SCORED} select layer, cast(n as bigint) rows_in_layer from (select 'events' layer, count(*) n from events union all select 'fact', count(*) from fact union all select 'predictions', count(*) from pred)""")
def funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.funnel(events=scan(spark, sf_dir, "events"), fact=fact(spark, sf_dir), predictions=scored(spark, sf_dir))


def _risk(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return scored(spark, sf_dir).select("repo_id", "pr_number", "breach_risk", "is_bot_author"), fact(spark, sf_dir)


@query(f"""{SCORED}, jj as (select p.repo_id, p.pr_number, breach_risk, is_bot_author, opened_at, closed_at from pred p join fact f on f.repo_id = p.repo_id and f.pr_number = p.pr_number), hz as (select max(opened_at) as as_of from jj)
select repo_id, pr_number, breach_risk, is_bot_author, cast(epoch(opened_at) as bigint) opened_at, cast(floor((epoch(as_of) - epoch(opened_at)) / 60) as bigint) minutes_open_at_horizon from jj, hz where closed_at is null order by breach_risk desc, repo_id, pr_number limit 200""")
def risk_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.risk_queue(*_risk(spark, sf_dir)).withColumn("opened_at", secs("opened_at"))


@query(f"{SCORED} select cast(d as bigint) risk_decile, round(avg(breach_risk), 4) mean_predicted, round(avg(case when breach then 1.0 else 0.0 end), 4) observed_rate, cast(count(*) as bigint) pull_requests from (select *, ntile(10) over (order by breach_risk, repo_id, pr_number) d from pred) group by 1")
def calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.calibration(scored(spark, sf_dir))


@query(f"{SCORED} select repo_id, cast(count(*) as bigint) pull_requests, round(avg(breach_risk), 4) mean_risk, round(avg(case when breach then 1.0 else 0.0 end), 4) observed_breach_rate from pred group by 1 having count(*) >= 50 order by 3 desc, 1 limit 100")
def risk_by_repo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.risk_by_repo(scored(spark, sf_dir))


@query(f"{SCORED} select is_bot_author, cast(count(*) as bigint) pull_requests, round(avg(breach_risk), 4) mean_predicted_risk, round(avg(case when breach then 1.0 else 0.0 end), 4) observed_breach_rate from pred group by 1")
def predicted_vs_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.predicted_vs_actual(scored(spark, sf_dir))


@query(f"{SCORED} select round(breach_risk, 1) breach_risk_bucket, cast(count(*) as bigint) pull_requests from pred group by 1")
def score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.score_histogram(scored(spark, sf_dir))


@query("select case when event_id % 3 = 0 then 'modern_v2' else 'reduced_v3' end schema_era, cast(epoch(date_trunc('month', ts + interval 700 day)) as bigint) \"month\", cast(count(*) as bigint) events from events group by 1, 2")
def era_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = scan(spark, sf_dir, "events").select(F.when(F.col("event_id") % 3 == 0, "modern_v2").otherwise("reduced_v3").alias("schema_era"), (F.col("ts") + F.expr("interval 700 days")).alias("created_at"))
    return reports.era_distribution(e).withColumn("month", secs("month"))


@query("select cast(epoch(date_trunc('hour', ts)) as bigint) \"hour\", cast(count(*) as bigint) predictions, round(avg(value + 0.0000001), 2) mean_model_ms, max(value + 0.0000001) max_model_ms, cast(sum(case when event_type = 'error' then 1 else 0 end) as bigint) non_200 from events group by 1")
def prediction_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = scan(spark, sf_dir, "events").select(F.col("ts").alias("request_time"), (F.col("value") + 1e-7).alias("execution_duration_ms"), F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code"))
    return reports.prediction_volume(e).withColumn("hour", secs("hour"))


@query("select user_id job_id, event_id run_id, cast(epoch(ts) as bigint) started, cast(value as bigint) duration_seconds, event_type result_state from (select *, timestamp '2024-01-30 00:00:00' n from events) where ts >= n - interval 10 day order by ts desc, user_id, event_id limit 200".replace("cast(epoch(ts) as bigint)", "cast(floor(epoch(ts)) as bigint)").replace("cast(value as bigint)", "cast(floor(value) as bigint)"))
def job_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = scan(spark, sf_dir, "events")
    start = F.col("ts")
    whole = F.timestamp_seconds(F.floor(F.unix_timestamp(start)))
    rows = e.select(F.col("user_id").alias("job_id"), F.col("event_id").alias("run_id"), start.alias("period_start_time"), F.timestamp_seconds(F.unix_timestamp(whole) + F.floor("value")).alias("period_end_time"), F.col("event_type").alias("result_state"))
    out = reports.job_runs(rows, datetime(2024, 1, 30, tzinfo=UTC), days=10)
    return out.select("job_id", "run_id", secs("period_start_time").alias("started"), "duration_seconds", "result_state")


@query(f"with c as ({CANONICAL}), d as ({DAILY}) select cast(activity_date as varchar) activity_date, cast(count(distinct repo_id) as bigint) repos_active, cast(sum(prs_opened) as bigint) prs_opened, cast(sum(prs_closed) as bigint) prs_closed, cast(sum(issues_opened) as bigint) issues_opened, cast(sum(pushes) as bigint) pushes from d group by 1")
def activation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.activation(gold.agg_repo_daily(canonical(spark, sf_dir))).withColumn("activity_date", F.col("activity_date").cast("string"))


@query(f"with c as ({CANONICAL}), d as ({DAILY}), f as (select repo_id, min(activity_date) cohort from d group by 1) select cast(cast(date_trunc('week', cohort) as date) as varchar) cohort_week, cast(floor(date_diff('day', cohort, activity_date) / 7) as bigint) weeks_since_first, cast(count(distinct d.repo_id) as bigint) repos_still_active from d join f on f.repo_id = d.repo_id group by 1, 2")
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.retention(gold.agg_repo_daily(canonical(spark, sf_dir))).withColumn("cohort_week", F.col("cohort_week").cast("string"))


PEOPLE = f"{FACT}, a as (select repo_id, author_login, count(*) prs from fact where author_login is not null and not author_is_bot group by 1, 2), rk as (select *, row_number() over (partition by repo_id order by prs desc, author_login) k, sum(prs) over (partition by repo_id order by prs desc, author_login rows between unbounded preceding and current row) c, sum(prs) over (partition by repo_id) t from a)"


@query(f"{PEOPLE} select cast(k as bigint) contributor_rank, cast(count(distinct repo_id) as bigint) repos, round(avg(prs / t), 4) mean_share_of_repo_prs from rk where k <= 10 group by 1")
def concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.concentration(fact(spark, sf_dir))


@query(f"{PEOPLE}, b as (select repo_id, min(k) bus_factor from rk where c * 2 >= t group by 1) select cast(bus_factor as bigint) bus_factor, cast(count(*) as bigint) repos from b group by 1")
def bus_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.bus_factor(fact(spark, sf_dir))


@query(f"{FACT}, s as (select author_is_bot, cast(epoch(closed_at) - epoch(opened_at) as bigint) s from fact where merged and closed_at is not null) select author_is_bot, cast(count(*) as bigint) merged_prs, " + ", ".join(f"round(quantile_disc(s, {p}) / 3600, 2) {n}_hours" for p, n in ((0.5, "p50"), (0.75, "p75"), (0.9, "p90"), (0.99, "p99"))) + " from s group by 1")
def time_to_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.time_to_merge(fact(spark, sf_dir))


@query(f"with c as ({CANONICAL}), s as ({SPINE}) select s.repo_id, s.pr_number, cast(count(*) as bigint) events_after_open from s join c on c.repo_id = s.repo_id and c.created_at > s.as_of and c.created_at < s.as_of + interval 24 hour group by 1, 2 order by 3 desc, 1, 2 limit 1")
def interval_busiest(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = canonical(spark, sf_dir)
    opens = features.pr_spine(c).select("repo_id", "pr_number", F.col("as_of_timestamp").alias("opened_at"))
    return reports.busiest_after_open(opens, c)


# ---- retrieval, learning, governance


@query("select event_id from events e where event_type = 'view' and not exists (select 1 from events o where o.event_type = 'click' and o.user_id = e.user_id and floor(o.value) = floor(e.value))")
def anti_new_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = scan(spark, sf_dir, "events")
    rows = e.select("event_id", F.col("user_id").cast("string").alias("entity_key"), F.floor("value").cast("string").alias("text_hash"), "event_type")
    return retrieval.pending(rows.where("event_type = 'view'"), rows.where("event_type = 'click'")).select("event_id")


@query("select event_id, 'pr:' || user_id || ':' || event_id key, case when event_id % 5 <> 0 then user_id end repo_id, case when event_id % 5 <> 0 then event_id end pr_number from events")
def entity_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = scan(spark, sf_dir, "events")
    key = T.entity_key("pr", F.col("user_id"), F.col("event_id"))
    parsed = T.split_entity_key(F.when(F.col("event_id") % 5 == 0, F.concat(key, F.lit(":x"))).otherwise(key))
    return e.select("event_id", key.alias("key"), parsed["repo_id"].alias("repo_id"), parsed["pr_number"].alias("pr_number"))


KNN = """with q as (select vec_id query_key, embedding x from embeddings where vec_id % 50 = 0), m as (select query_key, vec_id, list_distance(cast(x as double[]), cast(embedding as double[])) d from q, embeddings where vec_id <> query_key and vec_id < query_key + 300)"""


def _neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = scan(spark, sf_dir, "embeddings")
    time = lambda c: F.timestamp_seconds(c)
    spine = v.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_key"), time(F.col("vec_id") + 300).alias("as_of"), "embedding")
    return retrieval.nearest_before(spine, v.select(F.col("vec_id").alias("entity_key"), time(F.col("vec_id")).alias("event_time"), "embedding"), 10)


@query(f"{KNN} select query_key, vec_id entity_key, round(d, 6) distance, cast(n as integer) rank from (select *, row_number() over (partition by query_key order by d, vec_id) n from m) where n <= 10")
def knn_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _neighbours(spark, sf_dir).withColumn("distance", r6(F.col("distance")))


@query(f"{KNN}, t as (select query_key, vec_id from (select *, row_number() over (partition by query_key order by d, vec_id) n from m) where n <= 10) select q.query_key pr_number, cast(count(case when t.vec_id + 100 < q.query_key + 300 and t.vec_id % 3 <> 0 then 1 end) as bigint) similar_resolved_count, round(avg(case when t.vec_id + 100 < q.query_key + 300 and t.vec_id % 3 <> 0 then case when t.vec_id % 3 = 1 then 1.0 else 0.0 end end), 6) similar_breach_rate from q left join t on t.query_key = q.query_key group by 1")
def similarity_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = scan(spark, sf_dir, "embeddings").select(F.lit(1).cast("long").alias("repo_id"), F.col("vec_id").alias("pr_number"))
    key = lambda c: F.concat(F.lit("pr:1:"), F.col(c).cast("string"))
    found = _neighbours(spark, sf_dir).select(key("query_key").alias("query_key"), key("entity_key").alias("entity_key"))
    spine = v.where("pr_number % 50 = 0").withColumn("as_of_timestamp", F.timestamp_seconds(F.col("pr_number") + 300))
    third = F.col("pr_number") % 3
    ends = v.select("repo_id", "pr_number", F.timestamp_seconds(F.col("pr_number") + 100).alias("closed_at"), F.when(third != 0, third == 1).alias("breach"))
    return retrieval.similarity_features(spine, found, ends).select("pr_number", "similar_resolved_count", r6(F.col("similar_breach_rate")).alias("similar_breach_rate"))


@query("""with w as (select date_trunc('week', ts) as wk, count(*) n from events group by 1), s as (select wk, sum(n) over (order by wk desc) / sum(n) over () as share, row_number() over (order by wk) k from w),
b as (select wk from s where k > 1 order by abs(share - 0.2), wk limit 1) select cast(epoch(wk) as bigint) boundary, cast(count(*) filter (ts < wk) as bigint) train_rows, cast(count(*) filter (ts >= wk) as bigint) test_rows from events, b group by 1""")
def temporal_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = scan(spark, sf_dir, "events")
    at = F.lit(learning.split_week(e, "ts")).cast("timestamp")
    return e.agg(F.count_if(F.col("ts") < at).alias("train_rows"), F.count_if(F.col("ts") >= at).alias("test_rows")).select(F.unix_timestamp(at).alias("boundary"), "train_rows", "test_rows")


@query("""with b as (select event_type, quantile_cont(value, 0.5) p from events where user_id % 2 = 0 and event_type <> 'view' group by 1), a as (select quantile_cont(value, 0.5) p from events where user_id % 2 = 0 and event_type <> 'view')
select event_id, round(coalesce(b.p, a.p), 6) prediction from events e left join b on b.event_type = e.event_type, a where user_id % 2 = 1""")
def baseline_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = scan(spark, sf_dir, "events")
    baseline = learning.segment_baseline(e.where("user_id % 2 = 0 and event_type <> 'view'"), "value", "event_type")
    return learning.predict_baseline(e.where("user_id % 2 = 1"), baseline, "event_type").select("event_id", r6(F.col("prediction")).alias("prediction"))



@query("""with r as (select value from events where user_id % 2 = 0), c as (select value * 1.5 + 2 v from events where user_id % 2 = 1),
e as (select [""" + ", ".join(f"quantile_cont(value, {k / 10})" for k in range(1, 10)) + """] cuts from r),
rb as (select len(list_filter(cuts, lambda x: x < value)) b, count(*) / sum(count(*)) over () s from r, e group by 1), cb as (select len(list_filter(cuts, lambda x: x < v)) b, count(*) / sum(count(*)) over () s from c, e group by 1),
j as (select greatest(coalesce(rb.s, 0), 1e-6) e, greatest(coalesce(cb.s, 0), 1e-6) a from rb full join cb on rb.b = cb.b)
select 'value' "column", case when sum((a - e) * ln(a / e)) >= 0.25 then 'major' when sum((a - e) * ln(a / e)) >= 0.1 then 'moderate' else 'stable' end verdict, round(sum((a - e) * ln(a / e)), 6) psi from j""")
def drift_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = scan(spark, sf_dir, "events")
    found = drift.compare(e.where("user_id % 2 = 0").select("value"), e.where("user_id % 2 = 1").select((F.col("value") * 1.5 + 2).alias("value")), ["value"])
    return spark.createDataFrame([(f["column"], f["verdict"], round(f["psi"], 6)) for f in found], "column string, verdict string, psi double")


@query("""with e as (select event_id, case event_id % 4 when 0 then 'lake.bronze.raw' when 1 then 'lake.silver.events' when 2 then 'lake.gold.fact' else 'lake.external.x' end s,
 case event_id % 3 when 0 then 'lake.silver.events' when 1 then 'lake.gold.fact' else 'lake.features.f' end t, 'c' || (event_id % 7) col from events),
d as (select distinct s, t, col from e where s <> t), x as (select *, case when split_part(s, '.', 2) = 'external' then 'external' else split_part(s, '.', 2) end st, split_part(t, '.', 2) tt from d)
select st source_tier, tt target_tier, cast(count(distinct (s, t)) as bigint) table_edges, cast(count(*) as bigint) column_edges from x group by 1, 2""")
def lineage_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = scan(spark, sf_dir, "events")
    four, three = F.col("event_id") % 4, F.col("event_id") % 3
    missing = F.lit(None).cast("string")
    edges = e.select(
        F.when(four == 1, "lake.silver.events").when(four == 2, "lake.gold.fact").when(four == 3, "lake.external.x").alias("source_table_full_name"),
        F.when(four == 0, "abfss://bronze@store/raw/").alias("source_path"),
        F.concat(F.lit("c"), (F.col("event_id") % 7).cast("string")).alias("source_column_name"),
        F.when(three == 0, "lake.silver.events").when(three == 1, "lake.gold.fact").otherwise(missing).alias("target_table_full_name"),
        F.when(three == 2, "/data/features/f").alias("target_path"),
        F.concat(F.lit("c"), (F.col("event_id") % 7).cast("string")).alias("target_column_name"),
    )
    known = spark.createDataFrame([("lake.bronze.raw", "abfss://bronze@store/raw"), ("lake.features.f", "/data/features/f/")], "full_name string, storage_path string")
    return lineage.tier_edges(lineage.column_edges(edges, known))


@query("select doc_id, cast(len(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}')) as integer) n, regexp_extract(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}') first_found from documents where regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}')")
def pii_email_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(spark, sf_dir, "documents").where(F.col("text").contains("@")).select("doc_id", T.emails(F.col("text")).alias("e"))
    return found.where(F.size("e") > 0).select("doc_id", F.size("e").alias("n"), F.col("e")[0].alias("first_found"))


@query(f"with d as ({REPEATED}), v as (select 'duplicate_key' \"check\", cast(count(*) - count(distinct event_id) as bigint) violations from d where event_id is not null union all select 'user_small', cast(count(*) as bigint) from d where event_id is not null and user_id > 100) select * from v where violations > 0")
def contract_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _repeated(spark, sf_dir).where("event_id is not null")
    found = Contract.of(rows.schema, ["event_id"], {"user_small": "user_id <= 100"}).row_violations(rows)
    return spark.createDataFrame(sorted(found.items()), "check string, violations long")


@query("select event_id, user_id, event_type from events order by md5('0:' || event_id), event_id limit 100")
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of 100 events, by hash order."""
    return retrieval.hash_sample(scan(spark, sf_dir, "events"), ["event_id"], 100).select("event_id", "user_id", "event_type")


@query("select cast(event_id as varchar) event_id, user_id repo_id, cast(floor(epoch(ts)) as bigint) at_s from events")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events through the file stream, delivered twice in part, landed once."""
    from .streaming import ingest

    e = scan(spark, sf_dir, "events")
    root = work_folder(spark, "stream")
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    event = F.concat(F.lit('{"id":"'), F.col("event_id"), F.lit('","type":"PushEvent","created_at":"'), at, F.lit('","actor":"u","repo":{"id":'), F.col("user_id"), F.lit("}}"))
    rows = e.select(F.date_format(F.col("ts") + F.expr("interval 5 minutes"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("polled_at"), event.alias("event"))
    rows.union(rows.where(F.col("event").contains("7"))).repartition(4).write.json(f"{root}/landing")
    ingest.write_stream(ingest.stream_events(spark, f"{root}/landing", max_files=2), f"{root}/silver", f"{root}/checkpoint").awaitTermination()
    return ingest.read_silver(spark, f"{root}/silver").select("event_id", "repo_id", secs("created_at").alias("at_s"))
