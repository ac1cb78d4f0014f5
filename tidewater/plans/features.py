"""Feature tables, spines and training frames."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_bot
from ..operators.asof import as_of_join, running
from .gold import PR, closed, opened


def earliest_opened(events: DataFrame) -> DataFrame:
    """One opening a pull request: the earliest, unknown instants last; remaining
    ties by event_id, ingestion and author where those exist."""
    order = [F.col("created_at").asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ("event_id", "ingested_at", "actor_login") if c in events.columns]]
    ranked = events.where(opened() & F.col("repo_id").isNotNull() & F.col("pr_number").isNotNull())
    return ranked.withColumn("__n", F.row_number().over(Window.partitionBy(*PR).orderBy(*order))).where("__n = 1").drop("__n")


def pr_spine(events: DataFrame) -> DataFrame:
    return earliest_opened(events).select(*PR, F.col("actor_login").alias("author_login"), F.col("created_at").alias("as_of_timestamp"))


def repo_activity(events: DataFrame) -> DataFrame:
    """repo_id, event_time and running counts up to and with that instant."""
    rows = events.dropna(subset=["repo_id", "created_at"]).withColumnRenamed("created_at", "event_time")
    sums = running(
        rows, ["repo_id"], "event_time",
        events_total_to_date=F.lit(1),
        bot_events_to_date=F.coalesce(is_bot(F.col("actor_login")), F.lit(False)).cast("int"),
        prs_opened_to_date=F.coalesce(opened(), F.lit(False)).cast("int"),
    )
    return sums.withColumn("bot_share_to_date", F.col("bot_events_to_date") / F.col("events_total_to_date"))


def pr_static(events: DataFrame) -> DataFrame:
    at = F.col("created_at")
    return earliest_opened(events).select(*PR, F.col("pr_draft").alias("is_draft"), is_bot(F.col("actor_login")).alias("is_bot_author"), F.dayofweek(at).alias("opened_day_of_week"), F.hour(at).alias("opened_hour"))


def author_activity(events: DataFrame) -> DataFrame:
    """author_login, event_time (an opening by the author), pull requests of theirs
    that ended strictly before it and the share that was merged, among those
    whose outcome is known.  One window over openings and endings, so an author
    with many costs one sort and no pairs."""
    opens = earliest_opened(events).where(F.col("actor_login").isNotNull() & F.col("created_at").isNotNull())
    opens = opens.select(*PR, F.col("actor_login").alias("author_login"), F.col("created_at").alias("opened_at"))
    ends = events.where(closed() & F.col("created_at").isNotNull()).groupBy(*PR).agg(F.min_by("pr_merged", F.struct("created_at", F.coalesce(F.col("pr_merged"), F.lit(False)))).alias("merged"), F.min("created_at").alias("closed_at"))
    done = opens.join(ends, PR).select("author_login", F.col("closed_at").alias("t"), F.lit(1).alias("ended"), F.col("merged").isNotNull().cast("int").alias("known"), F.coalesce(F.col("merged"), F.lit(False)).cast("int").alias("won"))
    asked = opens.select("author_login", F.col("opened_at").alias("t")).distinct().select("*", F.lit(0).alias("ended"), F.lit(0).alias("known"), F.lit(0).alias("won"))
    line = Window.partitionBy("author_login").orderBy("t", "ended").rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c: F.coalesce(F.sum(c).over(line), F.lit(0))
    rows = done.unionByName(asked).select("author_login", "t", "ended", total("ended").alias("n"), total("known").alias("k"), total("won").alias("w")).where("ended = 0")
    return rows.select("author_login", F.col("t").alias("event_time"), F.col("n").alias("prior_pr_count"), F.when(F.col("k") > 0, F.col("w") / F.col("k")).alias("prior_merge_rate"))


def assemble(spine: DataFrame, author: DataFrame, repo: DataFrame, static: DataFrame) -> DataFrame:
    """The training frame: what was known of author and repository strictly before
    each spine instant, and the static columns of the pull request."""
    # the author's row at the very opening already looks strictly back, so it may be used at that instant
    exact = spine.join(author.withColumnRenamed("event_time", "as_of_timestamp"), ["author_login", "as_of_timestamp"], "left")
    return as_of_join(exact.select(*spine.columns, "prior_pr_count", "prior_merge_rate"), repo, ["repo_id"], "as_of_timestamp", "event_time").join(static, PR, "left")


@dataclass(frozen=True)
class FeatureTable:
    """How a feature table is computed, keyed and checked."""

    name: str
    compute: Callable[[DataFrame], DataFrame]
    entity: tuple[str, ...]
    time: str | None = "event_time"
    checks: tuple[tuple[str, str], ...] = ()

    @property
    def key(self) -> list[str]:
        return [*self.entity, *([self.time] if self.time else [])]


FEATURE_TABLES = (
    FeatureTable("repo_activity", repo_activity, ("repo_id",), checks=(("share", "bot_share_to_date between 0 and 1"), ("counts", "bot_events_to_date <= events_total_to_date"))),
    FeatureTable("author_activity", author_activity, ("author_login",), checks=(("rate", "prior_merge_rate is null or prior_merge_rate between 0 and 1"), ("count", "prior_pr_count >= 0"))),
    FeatureTable("pr_static", pr_static, ("repo_id", "pr_number"), None, (("hour", "opened_hour is null or opened_hour between 0 and 23"),)),
)


def build_features(store, events: DataFrame, tables: tuple[FeatureTable, ...] = FEATURE_TABLES) -> dict[str, int]:
    """Compute each table and commit it to ``store`` (a ``SnapshotStore``) as a new
    version under its contract; returns the versions."""
    from ..sources.snapshots import Contract

    out = {}
    for spec in tables:
        frame = spec.compute(events).dropna(subset=spec.key)
        out[spec.name] = store.table(spec.name).write(frame, Contract.of(frame.schema, spec.key, dict(spec.checks)))
    return out


def moved(early: dict, late: dict) -> list[str]:
    """Names of features that differ between two as-of vectors."""
    return [k for k in early if early[k] != late.get(k)]


def moved_names(early: DataFrame, late: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """keys, moved: names of the features that differ between the vectors of two
    instants (null and a value differ, nulls do not), for keys known at both."""
    other = late.select(*keys, *[F.col(c).alias(f"__{c}") for c in features])
    differs = F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"__{c}")), F.lit(c)) for c in features]))
    return early.join(other, keys).select(*keys, differs.alias("moved"))
