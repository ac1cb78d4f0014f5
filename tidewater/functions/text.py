"""Scalar expressions over events: names, keys, hashes, eras."""

from __future__ import annotations

import re
from datetime import UTC, datetime
from itertools import pairwise

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values.
KNOWN_BOTS = ("dependabot", "github-actions", "renovate")
BOT_PATTERN = r"(?i:(bot|automation)$)|(?i:[-_.]ci$)|[a-z0-9]CI$"
LEGACY_UNTIL = datetime(2015, 1, 1, tzinfo=UTC)
MODERN_UNTIL = datetime(2025, 10, 15, tzinfo=UTC)
ERAS = ("legacy_v1", "modern_v2", "reduced_v3")
NULL_MARK = r"\N"


def is_bot(login: Column) -> Column:
    """Whether a login is automated: a ``[bot]`` suffix, a known name, or the
    pattern.  Null for null."""
    return login.endswith("[bot]") | F.lower(login).isin(*KNOWN_BOTS) | login.rlike(BOT_PATTERN)


def bot_clause(login: str) -> str:
    """Which clause of ``is_bot`` holds: suffix, known, pattern or none."""
    if login.endswith("[bot]"):
        return "suffix"
    if login.lower() in KNOWN_BOTS:
        return "known"
    return "pattern" if re.search(BOT_PATTERN, login) else "none"


def bot_clause_column(login: Column) -> Column:
    """``bot_clause`` as a column; null for null."""
    found = F.when(login.endswith("[bot]"), "suffix").when(F.lower(login).isin(*KNOWN_BOTS), "known").when(login.rlike(BOT_PATTERN), "pattern")
    return F.when(login.isNotNull(), F.coalesce(found, F.lit("none")))


def era(at: Column) -> Column:
    """The schema era of an instant; unknown (null) for an unknown instant."""
    return (
        F.when(at < F.lit(LEGACY_UNTIL), F.lit(ERAS[0])).when(at < F.lit(MODERN_UNTIL), F.lit(ERAS[1])).when(at.isNotNull(), F.lit(ERAS[2]))
    )


def era_of(at: datetime) -> str:
    if at.tzinfo is None:
        raise ValueError("an instant needs a time zone")
    return ERAS[(at >= LEGACY_UNTIL) + (at >= MODERN_UNTIL)]


def content_key(*columns: Column) -> Column:
    """sha256 over the values joined by ``|``, nulls as a mark, so that a null
    and an empty string differ and no value is skipped."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit(NULL_MARK)) for c in columns]), 256)


def entity_key(kind: Column | str, repo: Column, number: Column) -> Column:
    return F.concat_ws(":", F.lit(kind) if isinstance(kind, str) else kind, repo.cast("string"), number.cast("string"))


def split_entity_key(key: Column) -> Column:
    """struct(kind, repo_id, pr_number) of ``kind:repo:number``; null otherwise."""
    parts = F.split(key, ":", -1)
    repo, number = F.try_element_at(parts, F.lit(2)).try_cast("long"), F.try_element_at(parts, F.lit(3)).try_cast("long")
    good = (F.size(parts) == 3) & repo.isNotNull() & number.isNotNull() & (F.try_element_at(parts, F.lit(1)) != "")
    return F.when(good, F.struct(F.try_element_at(parts, F.lit(1)).alias("kind"), repo.alias("repo_id"), number.alias("pr_number")))


def seconds_between(earlier: Column, later: Column) -> Column:
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def is_late(created: Column, ingested: Column, after_seconds: int) -> Column:
    return seconds_between(created, ingested) > after_seconds


EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def emails(text: Column) -> Column:
    """All e-mail addresses in a text."""
    return F.regexp_extract_all(text, F.lit(EMAIL), F.lit(0))


# What looks like an address and is none, or nobody's.
NOT_AN_IDENTITY = (".dfs.core.windows.net", ".blob.core.windows.net", "users.noreply.github.com", "@example.com")
SERVICE_LOGINS = ("runner", "runneradmin", "root", "admin", "ubuntu", "vsts", "jenkins", "circleci")
LEAST_IDENTIFIER = 3


def identifiers_of(hostname: str, login: str) -> list[str]:
    """Names that give away a machine or its user: host (with and without its local
    suffix) and login, unless too short to tell or a service's."""
    names = {hostname, hostname.removesuffix(".local"), login}
    return sorted(n for n in names if len(n) >= LEAST_IDENTIFIER and n.lower() not in SERVICE_LOGINS)


def identity_findings(rows: DataFrame, keys: list[str], text: str, identifiers: list[str] = ()) -> DataFrame:
    """keys, line (from 1), rule (email or identifier), match: each address that is
    somebody's and each identifier that stands as a word, once a line for every
    time an address occurs and once for an identifier.  Null texts have none."""
    lines = rows.where(F.col(text).isNotNull()).select(*keys, F.posexplode(F.split(text, r"\r\n|[\n\r]", -1)).alias("__n", "__line"))
    somebody = lambda m: ~F.array_contains(F.transform(F.array(*[F.lit(x) for x in NOT_AN_IDENTITY]), lambda x: F.contains(m, x)), True)
    found = [F.transform(F.filter(emails(F.col("__line")), somebody), lambda m: F.struct(F.lit("email").alias("rule"), m.alias("match")))]
    for name in identifiers:
        hit = F.struct(F.lit("identifier").alias("rule"), F.lit(name).alias("match"))
        found.append(F.when(F.col("__line").rlike(rf"\b{re.escape(name)}\b"), F.array(hit)).otherwise(F.array().cast("array<struct<rule:string,match:string>>")))
    out = lines.select(*keys, (F.col("__n") + 1).alias("line"), F.explode(F.concat(*found)).alias("f"))
    return out.select(*keys, "line", "f.rule", "f.match")


def json_paths(json: Column) -> Column:
    """Dotted paths of the fields of a JSON object, two levels deep; null for what is
    no object."""
    names = F.json_object_keys(json)
    inner = F.transform(names, lambda n: F.transform(F.coalesce(F.json_object_keys(F.get(F.map_values(F.map_filter(F.from_json(json, "map<string,string>"), lambda k, v: k == n)), 0)), F.array().cast("array<string>")), lambda m: F.concat(n, F.lit("."), m)))
    return F.when(names.isNotNull(), F.concat(names, F.flatten(inner)))


def field_paths(event: dict, depth: int = 2, prefix: str = "") -> set[str]:
    """Dotted paths of the fields of a JSON object, ``depth`` levels deep."""
    found = set()
    for name, value in event.items():
        found.add(path := f"{prefix}{name}")
        if isinstance(value, dict) and depth > 1:
            found |= field_paths(value, depth - 1, f"{path}.")
    return found


def compare_paths(a: set[str], b: set[str]) -> tuple[set[str], set[str], set[str]]:
    """Only in a, only in b, in both."""
    return a - b, b - a, a & b


def renames(seen: list[tuple[int, str, datetime]]) -> list[tuple[int, str, str, datetime]]:
    """(id, old name, new name, when) for each change of an id's name over time."""
    out = []
    for (i, name, _), (j, other, at) in pairwise(sorted(seen, key=lambda x: (x[0], x[2], x[1]))):
        if i == j and name != other:
            out.append((i, name, other, at))
    return out


def renames_in(rows: DataFrame, key: str, name: str, time: str = "created_at", tiebreak: str = "event_id") -> DataFrame:
    """key, old_name, new_name, changed_at: each change of a key's name over time.
    Rows with a null key, name or time are left out."""
    line = Window.partitionBy(key).orderBy(time, tiebreak)
    found = rows.dropna(subset=[key, name, time]).withColumn("__old", F.lag(name).over(line)).where(F.col("__old") != F.col(name))
    return found.select(key, F.col("__old").alias("old_name"), F.col(name).alias("new_name"), F.col(time).alias("changed_at"))


def repeat_share(ids: list[str]) -> float:
    """The share of a stream that repeats earlier ids."""
    return 1 - len(set(ids)) / len(ids) if ids else 0.0
