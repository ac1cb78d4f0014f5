"""Gold tables: pull-request lifecycle, fact, daily aggregate, name history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_bot, seconds_between

PR = ["repo_id", "pr_number"]
OPENED_ACTIONS, CLOSED_ACTIONS = ("opened",), ("closed", "merged")
RESPONSES = ("review", "review_comment", "issue_comment")


def opened() -> Column:
    return (F.col("event_type") == "PullRequestEvent") & F.col("event_action").isin(*OPENED_ACTIONS)


def closed() -> Column:
    return (F.col("event_type") == "PullRequestEvent") & F.col("event_action").isin(*CLOSED_ACTIONS)


def pr_events(events: DataFrame) -> DataFrame:
    """The events of pull requests' lives: repo_id, pr_number, kind, at, actor_login,
    draft, merged, ingested_at.  A comment on an issue counts where the issue is
    known to be a pull request: by its flag, or (where the era carries no flag)
    because a pull request of that number is seen."""
    rows = events.where(F.col("pr_number").isNotNull() & F.col("repo_id").isNotNull())
    kind = (
        F.when(opened(), "opened").when(closed(), "closed")
        .when(F.col("event_type") == "PullRequestReviewEvent", "review")
        .when(F.col("event_type") == "PullRequestReviewCommentEvent", "review_comment")
        .when(F.col("event_type") == "IssueCommentEvent", "issue_comment")
    )
    columns = [*PR, "kind", F.col("created_at").alias("at"), "actor_login", F.col("pr_draft").alias("draft"), F.col("pr_merged").alias("merged"), "ingested_at"]
    rows = rows.withColumn("kind", kind).where("kind is not null")
    sure = rows.where((F.col("kind") != "issue_comment") | F.coalesce("is_pr_comment", F.lit(False)))
    open_ones = rows.where((F.col("kind") == "issue_comment") & F.col("is_pr_comment").isNull())
    seen = rows.where(F.col("kind") != "issue_comment").select(*PR).distinct()
    return sure.select(*columns).unionByName(open_ones.join(seen, PR, "left_semi").select(*columns))


def fact_pull_request(life: DataFrame, responders: str = "any_non_author") -> DataFrame:
    """One row per pull request from its events (see ``pr_events``).

    All of it hangs on (repo_id, pr_number): the window that finds author and
    opening and the aggregate after it share one exchange.  ``responders`` may be
    ``human_only``, which leaves automated accounts out of the first response.
    """
    if responders not in ("any_non_author", "human_only"):
        raise ValueError(f"unknown responders {responders!r}")
    is_open, is_closed = F.col("kind") == "opened", F.col("kind") == "closed"
    start = F.when(is_open, F.struct(F.col("at").isNull().alias("late"), "at", "actor_login", "draft"))
    rows = life.withColumn("__o", F.min(start).over(Window.partitionBy(*PR)))
    other = F.col("kind").isin(*RESPONSES) & (F.col("actor_login") != F.col("__o.actor_login")) & (F.col("at") >= F.col("__o.at"))
    if responders == "human_only":
        other &= ~is_bot(F.col("actor_login"))
    end = F.when(is_closed, F.struct(F.col("at").isNull().alias("late"), "at", "merged"))
    fact = rows.groupBy(*PR).agg(
        F.first("__o").alias("__o"),
        F.min(end).alias("__c"),
        F.min(F.when(F.col("kind") == "review", F.col("at"))).alias("first_review_at"),
        F.min(F.when(other, F.col("at"))).alias("first_response_at"),
        F.max("ingested_at").alias("last_ingested_at"),
    )
    author, draft, opened_at = F.col("__o.actor_login"), F.col("__o.draft"), F.col("__o.at")
    closed_at = F.col("__c.at")
    exclusion = (
        F.when(author.isNull(), "author_unobserved")
        .when(F.coalesce(draft, F.lit(False)), "draft")
        .when(opened_at.isNull(), "open_unobserved")
        .when(F.col("first_response_at").isNull() & closed_at.isNull(), "right_censored")
        .when(F.col("first_response_at").isNull(), "closed_no_response")
    )
    fact = fact.withColumn("label_exclusion", exclusion)
    return fact.select(
        *PR,
        author.alias("author_login"),
        is_bot(author).alias("author_is_bot"),
        draft.alias("is_draft"),
        opened_at.alias("opened_at"),
        closed_at.alias("closed_at"),
        F.col("__c.merged").alias("merged"),
        "first_review_at",
        "first_response_at",
        F.when(F.col("label_exclusion").isNull(), seconds_between(opened_at, F.col("first_response_at"))).alias("time_to_first_response_seconds"),
        closed_at.isNull().alias("is_censored"),
        "label_exclusion",
        "last_ingested_at",
    )


def upsert(prior: DataFrame, recomputed: DataFrame, key: list[str]) -> DataFrame:
    """``prior`` with the rows of ``recomputed`` in place of those of equal key."""
    return prior.join(recomputed.select(*key), key, "left_anti").unionByName(recomputed)


def fact_incremental(prior: DataFrame, life: DataFrame, since, responders: str = "any_non_author") -> DataFrame:
    """The fact table after new events: pull requests with an event ingested at
    or after ``since`` are recomputed from all their events.  Recomputing is
    idempotent, so events stamped exactly ``since`` are never missed."""
    touched = life.where(F.col("ingested_at") >= F.lit(since)).select(*PR).distinct()
    return upsert(prior, fact_pull_request(life.join(touched, PR, "left_semi"), responders), PR)


def agg_repo_daily(events: DataFrame) -> DataFrame:
    """One row per repo and day of activity."""
    rows = events.where(F.col("repo_id").isNotNull() & F.col("created_at").isNotNull())
    kind, action = F.col("event_type"), F.col("event_action")
    return rows.groupBy("repo_id", F.to_date("created_at").alias("activity_date")).agg(
        F.count("*").alias("events_total"),
        F.count_if(is_bot(F.col("actor_login"))).alias("bot_events"),
        F.count_if(opened()).alias("prs_opened"),
        F.count_if(closed()).alias("prs_closed"),
        F.count_if((kind == "IssuesEvent") & (action == "opened")).alias("issues_opened"),
        F.count_if(kind.isin("IssueCommentEvent", "PullRequestReviewCommentEvent", "CommitCommentEvent")).alias("comments"),
        F.count_if(kind == "PushEvent").alias("pushes"),
        F.sum(F.when(kind == "PushEvent", F.col("push_size"))).alias("commits_pushed"),
        F.sum(F.when(kind == "PushEvent", F.col("push_distinct_size"))).alias("distinct_commits_pushed"),
        F.max("ingested_at").alias("last_ingested_at"),
    )


def name_history(events: DataFrame, key: str = "repo_id", name: str = "repo_name", time: str = "created_at", tiebreak: str = "event_id") -> DataFrame:
    """Slowly changing names by event time: key, name, valid_from, valid_to
    (exclusive; null while current).  Names compare case by case.  Rows with a
    null key, name or time are left out."""
    rows = events.dropna(subset=[key, name, time])
    line = Window.partitionBy(key).orderBy(time, tiebreak)
    changes = rows.withColumn("__before", F.lag(name).over(line)).where(~F.col(name).eqNullSafe(F.col("__before")))
    after = Window.partitionBy(key).orderBy("valid_from", tiebreak)
    changes = changes.select(key, name, F.col(time).alias("valid_from"), tiebreak)
    return changes.withColumn("valid_to", F.lead("valid_from").over(after)).drop(tiebreak)


def snapshot_names(current: DataFrame | None, observed: DataFrame, at, key: str = "repo_id", name: str = "repo_name") -> DataFrame:
    """Slowly changing names by run: ``observed`` has the latest name of each key.
    Rows whose name differs are closed at ``at`` and followed by a new one; keys
    that are not observed stay."""
    fresh = observed.select(key, F.col(name).alias("__new"))
    opening = lambda c: [F.col(key), F.col(c).alias(name), F.lit(at).cast("timestamp").alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to")]
    if current is None:
        return fresh.select(*opening("__new"))
    now = current.where("valid_to is null")
    met = now.join(fresh, key, "left")
    differs = F.col("__new").isNotNull() & ~F.col(name).eqNullSafe(F.col("__new"))
    kept = met.withColumn("valid_to", F.when(differs, F.lit(at).cast("timestamp"))).select(*current.columns)
    added = met.where(differs).select(*opening("__new")).unionByName(fresh.join(now.select(key), key, "left_anti").select(*opening("__new")))
    return current.where("valid_to is not null").unionByName(kept).unionByName(added)


def latest_name(events: DataFrame, key: str = "repo_id", name: str = "repo_name") -> DataFrame:
    """The last name of each key; the larger event_id wins at equal times."""
    rows = events.dropna(subset=[key, name, "created_at"])
    return rows.groupBy(key).agg(F.max_by(name, F.struct("created_at", "event_id")).alias(name))


def fact_violations(fact: DataFrame) -> DataFrame:
    """check, violations: all counts must be 0."""
    labelled = F.col("time_to_first_response_seconds").isNotNull()
    checks = {
        "label_xor_exclusion": labelled == F.col("label_exclusion").isNotNull(),
        "response_not_before_open": F.col("first_response_at") < F.col("opened_at"),
        "key_not_null": F.col("repo_id").isNull() | F.col("pr_number").isNull(),
        "known_exclusion": ~F.col("label_exclusion").isin("author_unobserved", "draft", "open_unobserved", "right_censored", "closed_no_response"),
        "censored_iff_open": F.col("is_censored") != F.col("closed_at").isNull(),
    }
    one = fact.agg(*[F.count_if(c).alias(n) for n, c in checks.items()], (F.count("*") - F.countDistinct(*[F.coalesce(F.col(k), F.lit(-1)) for k in PR])).alias("grain"))
    names = [*checks, "grain"]
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).cast("long").alias("violations")) for n in names])).alias("c")).select("c.check", "c.violations")


def orphans(rows: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Distinct non-null keys of ``rows`` that ``parent`` lacks; none in sound tables."""
    return rows.where(F.col(key).isNotNull()).select(key).distinct().join(parent.select(key), key, "left_anti")
