"""Duplicates, rules with quarantine, and completeness."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FAILED = "_failed_rules"


def deduplicate(events: DataFrame, key: str = "event_id", order: tuple[str, ...] = ("created_at", "ingested_at")) -> DataFrame:
    """The earliest row of each key; rows without a key are kept as they are.
    Remaining ties are broken by all other columns."""
    first = [F.col(c).asc_nulls_last() for c in order]
    rest = [F.col(c).asc_nulls_last() for c in events.columns if c != key and c not in order and not events.schema[c].dataType.typeName() == "map"]
    ranked = events.where(F.col(key).isNotNull()).withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(*first, *rest)))
    return ranked.where("__n = 1").drop("__n").unionByName(events.where(F.col(key).isNull()))


def duplicate_stats(events: DataFrame, key: str = "event_id") -> DataFrame:
    """One row: total rows with a key, distinct keys, redundant rows."""
    return events.where(F.col(key).isNotNull()).agg(F.count("*").alias("total"), F.countDistinct(key).alias("distinct")).withColumn("duplicates", F.col("total") - F.col("distinct"))


@dataclass(frozen=True)
class Rule:
    name: str
    expression: str
    severity: str = "reject"

    def __post_init__(self) -> None:
        if self.severity not in ("reject", "warn"):
            raise ValueError(f"unknown severity {self.severity!r}")


# The rules that event tables ship with.
EVENT_RULES = (
    Rule("event_id_present", "event_id IS NOT NULL AND length(event_id) > 0"),
    Rule("created_at_present", "created_at IS NOT NULL"),
    Rule("created_at_not_future", "created_at <= ingested_at"),
    Rule("repo_id_present", "repo_id IS NOT NULL"),
    Rule("actor_login_present", "actor_login IS NOT NULL AND length(actor_login) > 0", "warn"),
    Rule("event_type_present", "event_type IS NOT NULL"),
)


def failed_rules(rules: list[Rule] | tuple[Rule, ...], severity: str | None = "reject") -> Column:
    """The names of the rules that a row fails; a rule that is null fails."""
    tests = [F.when(~F.coalesce(F.expr(r.expression), F.lit(False)), F.lit(r.name)) for r in rules if severity in (None, r.severity)]
    return F.array_compact(F.array(*tests)) if tests else F.array().cast("array<string>")


def apply_rules(rows: DataFrame, rules: list[Rule] | tuple[Rule, ...] = EVENT_RULES) -> DataFrame:
    """Annotate rows with the rejecting rules they fail and the warnings they raise."""
    names = [r.name for r in rules]
    if len(set(names)) != len(names):
        raise ValueError("rule names must be unique")
    return rows.withColumn(FAILED, failed_rules(rules))


def warnings(rules: list[Rule] | tuple[Rule, ...] = EVENT_RULES) -> Column:
    return failed_rules(rules, "warn")


def split(annotated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean without the annotation, quarantined with it); together all rows."""
    bad = F.size(FAILED) > 0
    return annotated.where(~bad).drop(FAILED), annotated.where(bad)


def quarantine_by_rule(annotated: DataFrame) -> DataFrame:
    """rule, rows_failed, and a total row."""
    bad = annotated.where(F.size(FAILED) > 0)
    each = bad.select(F.explode(FAILED).alias("rule")).groupBy("rule").agg(F.count("*").alias("rows_failed"))
    return bad.agg(F.count("*").alias("rows_failed")).select(F.lit("ALL RULES (total quarantined)").alias("rule"), "rows_failed").unionByName(each)


def expected_hours(spark, start: datetime, end: datetime) -> DataFrame:
    """Every hour from ``start`` to ``end``, both included."""
    if start.tzinfo is None or end.tzinfo is None:
        raise ValueError("hours need a time zone")
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 hour"))).alias("hour")) if start <= end else spark.createDataFrame([], "hour timestamp")


def missing_hours(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Expected hours of which ``present`` (column hour) has no row."""
    return expected.join(present.select("hour").distinct(), "hour", "left_anti")


@dataclass(frozen=True)
class GapReport:
    expected: int
    present: int
    missing: list[datetime] = field(default_factory=list)

    @property
    def complete(self) -> bool:
        return not self.missing

    @classmethod
    def of(cls, start: datetime, end: datetime, seen: set[datetime]) -> GapReport:
        hours = [start + timedelta(hours=k) for k in range(int((end - start).total_seconds() // 3600) + 1)]
        missing = sorted(h for h in hours if h not in seen)
        return cls(len(hours), len(hours) - len(missing), missing)


# What a window of events must hold to be of use.
RESPONSE_TYPES = ("IssueCommentEvent", "PullRequestReviewEvent", "PullRequestReviewCommentEvent")
LEAST_PULL_SHARE = 0.03
LEAST_RESPONSE_SHARE = 0.03
LEAST_OPENED = 1_000


def window_profile(events: DataFrame, pull: str = "PullRequestEvent", responses: tuple[str, ...] = RESPONSE_TYPES, opened: Column | None = None, draft: Column | None = None) -> DataFrame:
    """One row: hours, totals, shares of event types, and the rules it fails."""
    is_pull = F.col("event_type") == pull
    opened = opened if opened is not None else is_pull & (F.col("event_action") == "opened")
    draft = draft if draft is not None else is_pull & F.col("pr_draft").isNotNull()
    one = events.agg(
        F.countDistinct(F.date_trunc("hour", "created_at")).alias("hours"),
        F.count("*").alias("total_events"),
        F.count_if(opened).alias("opened_prs"),
        F.count_if(is_pull).alias("__pulls"),
        F.count_if(F.col("event_type").isin(*responses)).alias("__responses"),
        F.coalesce(F.bool_or(draft), F.lit(False)).alias("carries_draft"),
    )
    share = lambda c: F.when(F.col("total_events") > 0, F.col(c) / F.col("total_events")).otherwise(F.lit(0.0))
    one = one.withColumns({"pull_request_share": share("__pulls"), "response_share": share("__responses")})
    some = F.array_compact(
        F.array(
            F.when(F.col("pull_request_share") < LEAST_PULL_SHARE, F.lit("pull_request_share")),
            F.when(F.col("response_share") < LEAST_RESPONSE_SHARE, F.lit("review_signal_share")),
            F.when(F.col("opened_prs") < LEAST_OPENED, F.lit("opened_prs")),
        )
    )
    return one.withColumn("failed_rules", F.when(F.col("total_events") == 0, F.array(F.lit("no_events"))).otherwise(some)).drop("__pulls", "__responses")
