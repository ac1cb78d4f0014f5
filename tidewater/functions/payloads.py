"""Raw JSON events of three schema eras, parsed once into one flat shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import content_key, era

#: ``actor`` is declared as text: it is a name in old events and an object in
#: new ones, and ``from_json`` hands an object over as its JSON text.
EVENT = (
    "id string, type string, created_at string, url string, actor string, "
    "repo struct<id: bigint, name: string>, repository struct<id: bigint, name: string, owner: string>, "
    "payload struct<action: string, number: bigint, "
    "pull_request: struct<number: bigint, merged: boolean, draft: boolean>, "
    "issue: struct<number: bigint, pull_request: struct<url: string>>, size: bigint, distinct_size: bigint>"
)

CANONICAL = (
    "event_id", "event_id_source", "actor_login", "created_at", "repo_id", "repo_name", "event_type", "event_action",
    "schema_era", "ingested_at", "event_date", "event_hour", "pr_number", "pr_merged", "pr_draft", "is_pr_comment",
    "push_size", "push_distinct_size",
)


def _login(actor: Column) -> Column:
    # an object's text has a login; any other text is the name itself, but broken JSON objects name nobody
    return F.coalesce(F.get_json_object(actor, "$.login"), F.when(~F.trim(actor).startswith("{"), actor))


def _merged(p: Column, kind: Column) -> Column:
    """The flag where an era carries it, else what the action says of a pull
    request that ends; unknown for other actions."""
    action = p["action"]
    told = F.when(action == "merged", F.lit(True)).when(action == "closed", F.lit(False))
    return F.coalesce(p["pull_request"]["merged"], F.when(kind == "PullRequestEvent", told))


def parse_events(raw: DataFrame, json_column: str = "raw_json") -> DataFrame:
    """Flat columns from the JSON text, next to all other columns of ``raw``.
    Text that is no JSON gives nulls; unknown fields are ignored."""
    rest = [c for c in raw.columns if c != json_column]
    parsed = raw.select(F.from_json(F.col(json_column), EVENT).alias("__e"), *rest)
    e, p = F.col("__e"), F.col("__e.payload")
    old_name = F.concat(e["repository"]["owner"], F.lit("/"), e["repository"]["name"])  # null if either is
    return parsed.select(
        e["created_at"].alias("created_at_raw"),
        _login(e["actor"]).alias("actor_login"),
        F.coalesce(e["repo"]["id"], e["repository"]["id"]).alias("repo_id"),
        F.coalesce(e["repo"]["name"], old_name).alias("repo_name"),
        e["type"].alias("event_type"),
        p["action"].alias("event_action"),
        e["id"].alias("native_id"),
        e["url"].alias("event_url"),
        F.coalesce(p["pull_request"]["number"], p["issue"]["number"], p["number"]).alias("pr_number"),
        _merged(p, e["type"]).alias("pr_merged"),
        p["pull_request"]["draft"].alias("pr_draft"),
        F.when(p["issue"].isNotNull(), p["issue"]["pull_request"].isNotNull()).alias("issue_is_pr"),
        p["size"].alias("push_size"),
        p["distinct_size"].alias("push_distinct_size"),
        *rest,
    )


def normalize_events(parsed: DataFrame) -> DataFrame:
    """The canonical columns.  Instants that cannot be read are null (and fail
    the rules later) rather than stopping the job.  Events without an id get a
    content hash over what identifies them, with the instant in epoch seconds."""
    at = F.try_to_timestamp("created_at_raw")
    seconds = F.unix_timestamp(at)
    surrogate = content_key(*[F.col(c) for c in ("event_type", "actor_login", "repo_id", "repo_name")], seconds, F.col("event_url"), F.col("event_action"), F.col("pr_number"))
    named = F.col("native_id").isNotNull() & (F.col("native_id") != "")
    comment = F.when(F.col("event_type") == "IssueCommentEvent", F.when(era(at) != "legacy_v1", F.col("issue_is_pr")))
    # without a type and an instant there is nothing that could identify the event
    event_id = F.when(named, F.col("native_id")).when(F.col("event_type").isNotNull() | at.isNotNull(), surrogate)
    return parsed.select(
        event_id.alias("event_id"),
        F.when(named, F.lit("native")).otherwise(F.lit("content_hash")).alias("event_id_source"),
        "actor_login",
        at.alias("created_at"),
        "repo_id",
        "repo_name",
        "event_type",
        "event_action",
        era(at).alias("schema_era"),
        "ingested_at",
        "event_date",
        "event_hour",
        "pr_number",
        "pr_merged",
        "pr_draft",
        comment.alias("is_pr_comment"),
        "push_size",
        "push_distinct_size",
    )
