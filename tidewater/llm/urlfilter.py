"""URL filters: host and path rules, then a list of canonical URLs.

The longest rule that fits an address decides.  Other addresses are looked up
in the list: a blocked Bloom filter (one block of eight 32-bit words for an
address, one bit in each word) passes possible hits, and only these meet the
list in an exact hash join, which removes false positives.

The filter is a table of blocks.  It is broadcast where its size, computed from
the number of listed addresses, stays below ``BROADCAST_BYTES``; beyond that it
is joined by shuffle on the block number.  The table of addresses that are
judged is read twice: once for the distinct possible hits, which meet the list,
and once for the result.

Nulls: a null address, or one without ``://``, has an empty host and path, fits
no rule, is on no list and is allowed.  Empty and very long addresses are judged
like others, whole.  Nulls and repeats in the list are ignored.  Repeated rows get
equal verdicts.  Of rules of equal length the later in code-point order wins.
Only the id and the address are looked at, whatever other columns there are.
With an empty list nothing is blocked by it; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import scratch
from .rowkeys import free

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A block has 256 bits; so many addresses share one on average (16 bits each).
PER_BLOCK = 16
BROADCAST_BYTES = 64 << 20


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """host + path without scheme, ``www.``, port, query, fragment, a trailing
    ``/`` or ``.html``; null where there is no host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":\d+$", "")
    path = F.regexp_replace(path_of(url), r"(/+|\.html?)$", "")
    return F.when(host != "", F.concat(host, path))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """``rules``: (allow or block, host + path).  Columns rule and verdict of the
    longest that fits a host or its parent domains and a path's beginning."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is asked first
        own, _, rest = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    """One set bit for each of the eight words."""
    h = F.xxhash64(F.lit("bits"), key)
    five = [F.pmod(F.shiftrightunsigned(h, 5 * i), F.lit(32)) for i in range(8)]
    return [F.call_function("shiftleft", F.lit(1), f.cast("int")) for f in five]


def bloom_blocks(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """__block and the words w0..w7 of the blocks that hold an address."""
    rows = listed.select(_block(F.col(key), blocks).alias("__block"), *[b.alias(f"w{i}") for i, b in enumerate(_bits(F.col(key)))])
    return rows.groupBy("__block").agg(*[F.expr(f"bit_or(w{i})").alias(f"w{i}") for i in range(8)])


def on_list(rows: DataFrame, key: str, listed: DataFrame) -> DataFrame:
    """``rows`` plus ``listed`` (boolean): whether ``key`` is in the one column of
    ``listed`` (same name)."""
    names = scratch.table(listed.select(F.col(key).alias("__key")).where("__key is not null").distinct(), "listed")
    count = names.count()
    block, hit, ask, maybe, *words = free(rows.columns, "__block", "__hit", "__ask", "__maybe", *[f"w{i}" for i in range(8)])
    if not count:
        return rows.withColumn("listed", F.lit(False))
    blocks = -(-count // PER_BLOCK)
    bloom = bloom_blocks(names, "__key", blocks).toDF(block, *words)
    if blocks * 40 <= BROADCAST_BYTES:
        bloom = F.broadcast(bloom)
    # rows that cannot match carry keys of their own, so that no task gets them all
    alone = F.concat(F.lit("\x00"), F.monotonically_increasing_id().cast("string"))
    probe = rows.withColumn(block, _block(F.coalesce(F.col(key), alone), blocks)).join(bloom, block, "left")
    possible = F.col(key).isNotNull()
    for word, bit in zip(words, _bits(F.col(key))):
        possible &= F.col(word).bitwiseAND(bit) == bit
    probe = probe.withColumn(hit, F.coalesce(possible, F.lit(False))).drop(block, *words)
    sure = probe.where(F.col(hit)).select(F.col(key).alias(maybe)).distinct().join(names, F.col(maybe) == F.col("__key"), "left_semi")
    sure = scratch.table(sure, "sure")
    asked = probe.withColumn(ask, F.when(F.col(hit), F.col(key)).otherwise(alone)).join(sure, F.col(ask) == F.col(maybe), "left")
    return asked.withColumn("listed", F.col(maybe).isNotNull()).drop(hit, ask, maybe)


def judge(pages: DataFrame, rules: list[tuple[str, str]], listed: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict.  ``listed``: column canonical."""
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("canonical"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("verdict", verdict)
    decided = rows.where("rule is not null").drop("canonical")
    asked = on_list(rows.where("rule is null"), "canonical", listed)
    asked = asked.withColumn("verdict", F.when(F.col("listed"), "block").otherwise("allow")).drop("canonical", "listed")
    return decided.unionByName(asked)
