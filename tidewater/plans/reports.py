"""Reporting queries over predictions, fact, daily aggregate and event tables.

Every ordering ends in a unique tiebreak, so reports are the same on each run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import seconds_between
from ..operators.ranks import ntile, quantiles

PR = ["repo_id", "pr_number"]


def _breach():
    return F.avg(F.when(F.col("breach"), 1.0).otherwise(0.0))


def risk_queue(predictions: DataFrame, fact: DataFrame, top: int = 200) -> DataFrame:
    """Unresolved pull requests by risk; minutes open at the scored population's horizon."""
    rows = predictions.join(fact.select(*PR, "opened_at", "closed_at"), PR)
    horizon = rows.agg(F.max("opened_at").alias("as_of"))
    out = rows.where("closed_at is null").crossJoin(F.broadcast(horizon))  # one row
    return out.select(*PR, "breach_risk", "is_bot_author", "opened_at", F.floor(seconds_between(F.col("opened_at"), F.col("as_of")) / 60).alias("minutes_open_at_horizon")).orderBy(F.desc("breach_risk"), *PR).limit(top)


def calibration(predictions: DataFrame, groups: int = 10) -> DataFrame:
    """Deciles of risk (ties by pull request) with mean prediction and observed rate.
    Rows without a risk or a key have no decile."""
    rows = ntile(predictions.dropna(subset=["breach_risk", *PR]), groups, ["breach_risk", *PR], "risk_decile")
    return rows.groupBy("risk_decile").agg(F.round(F.avg("breach_risk"), 4).alias("mean_predicted"), F.round(_breach(), 4).alias("observed_rate"), F.count("*").alias("pull_requests"))


def risk_by_repo(predictions: DataFrame, least: int = 50, top: int = 100) -> DataFrame:
    rows = predictions.groupBy("repo_id").agg(F.count("*").alias("pull_requests"), F.round(F.avg("breach_risk"), 4).alias("mean_risk"), F.round(_breach(), 4).alias("observed_breach_rate"))
    return rows.where(F.col("pull_requests") >= least).orderBy(F.desc("mean_risk"), "repo_id").limit(top)


def predicted_vs_actual(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("is_bot_author").agg(F.count("*").alias("pull_requests"), F.round(F.avg("breach_risk"), 4).alias("mean_predicted_risk"), F.round(_breach(), 4).alias("observed_breach_rate"))


def funnel(**layers: DataFrame) -> DataFrame:
    """layer, rows_in_layer."""
    out = None
    for name, df in layers.items():
        one = df.agg(F.count("*").alias("rows_in_layer")).select(F.lit(name).alias("layer"), "rows_in_layer")
        out = one if out is None else out.unionByName(one)
    return out


def era_distribution(events: DataFrame) -> DataFrame:
    return events.groupBy("schema_era", F.date_trunc("month", "created_at").alias("month")).agg(F.count("*").alias("events"))


def job_runs(timeline: DataFrame, now, days: int = 30, top: int = 200) -> DataFrame:
    """job_id, run_id, times, seconds and state of the runs of the last days."""
    recent = timeline.where(F.col("period_start_time") >= F.lit(now) - F.expr(f"interval {days} days"))
    return recent.select("job_id", "run_id", "period_start_time", "period_end_time", seconds_between(F.col("period_start_time"), F.col("period_end_time")).alias("duration_seconds"), "result_state").orderBy(F.desc("period_start_time"), "job_id", "run_id").limit(top)


def prediction_volume(log: DataFrame) -> DataFrame:
    """By hour of request: predictions, mean and largest milliseconds, errors."""
    return log.groupBy(F.date_trunc("hour", "request_time").alias("hour")).agg(F.count("*").alias("predictions"), F.round(F.avg("execution_duration_ms"), 2).alias("mean_model_ms"), F.max("execution_duration_ms").alias("max_model_ms"), F.sum(F.when(F.col("status_code") != 200, 1).otherwise(0)).alias("non_200"))


def score_histogram(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy(F.round("breach_risk", 1).alias("breach_risk_bucket")).agg(F.count("*").alias("pull_requests"))


def activation(daily: DataFrame) -> DataFrame:
    return daily.groupBy("activity_date").agg(F.countDistinct("repo_id").alias("repos_active"), *[F.sum(c).alias(c) for c in ("prs_opened", "prs_closed", "issues_opened", "pushes")])


def retention(daily: DataFrame) -> DataFrame:
    """Repos still active by weeks since their first day, by week of that day."""
    first = F.min("activity_date").over(Window.partitionBy("repo_id"))
    rows = daily.select("repo_id", "activity_date", first.alias("cohort"))
    weeks = F.floor(F.datediff("activity_date", "cohort") / 7)
    return rows.groupBy(F.to_date(F.date_trunc("week", "cohort")).alias("cohort_week"), weeks.cast("long").alias("weeks_since_first")).agg(F.countDistinct("repo_id").alias("repos_still_active"))


def _by_author(fact: DataFrame) -> DataFrame:
    people = fact.where("author_login is not null and not author_is_bot").groupBy("repo_id", "author_login").agg(F.count("*").alias("prs"))
    line = Window.partitionBy("repo_id").orderBy(F.desc("prs"), "author_login")
    return people.select("repo_id", "prs", F.row_number().over(line).alias("contributor_rank"), F.sum("prs").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("cumulative_prs"), F.sum("prs").over(Window.partitionBy("repo_id")).alias("repo_prs"))


def concentration(fact: DataFrame, ranks: int = 10) -> DataFrame:
    rows = _by_author(fact).where(F.col("contributor_rank") <= ranks)
    return rows.groupBy(F.col("contributor_rank").cast("long").alias("contributor_rank")).agg(F.countDistinct("repo_id").alias("repos"), F.round(F.avg(F.col("prs") / F.col("repo_prs")), 4).alias("mean_share_of_repo_prs"))


def bus_factor(fact: DataFrame) -> DataFrame:
    """How many repos need so many contributors to reach half of their pull requests."""
    half = _by_author(fact).where(F.col("cumulative_prs") * 2 >= F.col("repo_prs"))
    return half.groupBy("repo_id").agg(F.min("contributor_rank").cast("long").alias("bus_factor")).groupBy("bus_factor").agg(F.count("*").alias("repos"))


def time_to_merge(fact: DataFrame) -> DataFrame:
    """Percentiles of hours from opening to merge, by kind of author: exact, from
    counts of distinct seconds."""
    rows = fact.where("merged and closed_at is not null and opened_at is not null").select("author_is_bot", seconds_between(F.col("opened_at"), F.col("closed_at")).alias("s"))
    found = quantiles(rows, "s", {"p50": 0.5, "p75": 0.75, "p90": 0.9, "p99": 0.99}, ["author_is_bot"])
    counts = fact.where("merged and closed_at is not null").groupBy(F.col("author_is_bot").alias("kind")).agg(F.count("*").alias("merged_prs"))
    out = counts.join(found, F.col("kind").eqNullSafe(F.col("author_is_bot")), "left")
    return out.select(F.col("kind").alias("author_is_bot"), "merged_prs", *[F.round(F.col(p) / 3600, 2).alias(f"{p}_hours") for p in ("p50", "p75", "p90", "p99")])


def busiest_after_open(fact: DataFrame, events: DataFrame, hours: int = 24) -> DataFrame:
    """The pull request whose repository saw most events in the hours after it
    opened, bounds excluded: one row, or none.

    The events between two instants are the difference of two running counts.
    These are sums over whole hours of a repository, plus a window inside the
    hour, so a busy repository is spread over its hours and nothing is paired.
    """
    opens = fact.where("opened_at is not null and repo_id is not null").groupBy(*PR, "opened_at").agg(F.count("*").alias("times"))
    near = events.where("created_at is not null and repo_id is not null").select("repo_id", F.col("created_at").alias("t"), F.lit(1).alias("side"), F.lit(1).alias("one"))
    # at its opening a probe comes after the events of that instant, at its end before them
    ends = F.explode(F.array(F.struct(F.col("opened_at").alias("t"), F.lit(2).alias("side"), F.lit(-1).alias("sign")), F.struct((F.col("opened_at") + F.expr(f"interval {hours} hours")).alias("t"), F.lit(0).alias("side"), F.lit(1).alias("sign")))).alias("p")
    probes = opens.select(*PR, "times", ends).select("repo_id", "p.t", "p.side", F.lit(0).alias("one"), "pr_number", "times", "p.sign")
    line = near.unionByName(probes, allowMissingColumns=True).withColumn("hour", F.date_trunc("hour", "t"))
    per_hour = line.groupBy("repo_id", "hour").agg(F.sum("one").alias("n"))
    before = Window.partitionBy("repo_id").orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)  # a row an hour
    starts = per_hour.select("repo_id", "hour", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("repo_id", "hour").orderBy("t", "side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = line.withColumn("n", F.sum("one").over(inside)).where("sign is not null").join(starts, ["repo_id", "hour"])
    counts = known.groupBy(*PR).agg(F.sum(F.col("sign") * F.col("times") * (F.col("start") + F.col("n"))).alias("events_after_open"))
    return counts.where("events_after_open > 0").orderBy(F.desc("events_after_open"), *PR).limit(1)
