"""The operators of this folder over the tables of the catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, decontam, kneserney, langid, mixing, neardup, quality, sharding, toxicity, urlfilter
from .labelled import fold


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    out = toxicity.toxicity(docs, labels, fold(F.col("doc_id"), 4) != 2)
    return out.select("doc_id", _is(4, 2).alias("held_out"), "score", "predicted", "predicted_by_lang")


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("copies")


def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kneserney.perplexity(_table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 7) != 2)
    return out.select("doc_id", _is(7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "documents"))


RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
# The list of blocked addresses, an input of its own: all canonical addresses of
# some sites whose number leaves a remainder below 3 when divided by 4.
SITES = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
SUBDOMAINS, SUFFIXES, LANGUAGES, NUMBERS = ("", "blog.", "m."), ("com", "net", "org"), ("de", "en", "es", "fr"), 1000


def blocked_addresses(spark: SparkSession) -> DataFrame:
    """canonical: addresses on the list, of pages that exist and of others."""
    rest, parts = F.col("id"), []
    for values in (SITES, SUBDOMAINS, SUFFIXES, LANGUAGES):
        parts.append(F.element_at(F.array(*[F.lit(v) for v in values]), (rest % len(values) + 1).cast("int")))
        rest = F.floor(rest / len(values))
    site, sub, suffix, lang = parts
    rows = spark.range(len(SITES) * len(SUBDOMAINS) * len(SUFFIXES) * len(LANGUAGES) * NUMBERS).where(rest % 4 < 3)
    return rows.select(F.concat(sub, site, F.lit(".example."), suffix, F.lit("/"), lang, F.lit("/"), rest.cast("string")).alias("canonical"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(_table(spark, sf_dir, "pages"), RULES, blocked_addresses(spark))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    out = quality.quality(docs, labels, fold(F.col("doc_id"), 5) != 0)
    return out.select("doc_id", _is(5, 0).alias("held_out"), "score", "predicted")


def _is(folds: int, value: int):
    return F.coalesce(fold(F.col("doc_id"), folds) == value, F.lit(False))


QUERIES = {
    f.__name__: f
    for f in (op1_toxicity, op2_nearest_neighbours, op3_decontamination, op4_near_duplicates, op5_sharding, op6_mixing, op7_kneser_ney, op8_language_id, op9_url_filter, op10_quality)
}

#: Ranks, targets and integer crossings as in ``mixing``; offsets are the first 28 bits of an MD5.
_MIXING = r"""
with d as (select doc_id, source, case when text is null then 0 else len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) end size from documents),
s as (select source, sum(size)::bigint source_size from d group by 1),
w as (select *, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 3.0::double when 1 then 1.0::double else 2.0::double end w, 2.0::double * source_size cap from s),
o as (select *, 1.5::double * (sum(source_size) over ())::double as total,
  coalesce(sum(cap) over (order by cap / w, source nulls last rows between unbounded preceding and 1 preceding), 0) as before_cap,
  sum(w) over () - coalesce(sum(w) over (order by cap / w, source nulls last rows between unbounded preceding and 1 preceding), 0) as rest from w),
l as (select *, (total - before_cap) / rest as level from o),
f as (select (select level from l where level * w <= cap order by cap / w, source nulls last limit 1) as fixed),
t as (select l.source, l.source_size, case when fixed is null then cap else least(cap, fixed * w) end target from l, f),
e as (select *, case when source_size > 0 then floor(target / source_size * 268435456)::bigint else 0 end each_,
  ('0x' || substr(md5(concat('17:', coalesce('=' || source, 'null'))), 1, 7))::bigint as off_ from t),
r as (select d.*, row_number() over (partition by source order by size, doc_id nulls first) - 1 as k from d)
select r.doc_id, r.source, r.size::bigint size, e.source_size, e.target::double target,
  (((off_ + (k + 1) * each_) // 268435456 - (off_ + k * each_) // 268435456) * r.size)::bigint taken
from r join e on e.source is not distinct from r.source"""

_URLS = r"""
with u as (select page_id, url, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) end rest from pages),
h as (select page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') host, coalesce(regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1), '') path from u),
r as (select *, case when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/en/1') then 'example.org/en/1'
  when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/es/') then 'example.org/es/'
  when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/fr/') then 'com/fr/'
  when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/de/') then 'com/de/'
  when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/') then 'org/' end as rule_,
  case when host <> '' then regexp_replace(regexp_replace(host, '^www\.', ''), ':[0-9]+$', '') || regexp_replace(path, '(/+|\.html?)$', '') end canonical from h),
l as (select sub || site || '.example.' || suffix || '/' || lang || '/' || n as listed
  from (values ('adult-x'), ('ads-track'), ('casino-win'), ('cheap-pills'), ('free-bets'), ('spam-farm')) a(site), (values (''), ('blog.'), ('m.')) b(sub),
  (values ('com'), ('net'), ('org')) c(suffix), (values ('de'), ('en'), ('es'), ('fr')) d(lang), range(1000) e(n) where n % 4 < 3)
select page_id, host, path, rule_ as "rule", case when rule_ in ('org/', 'com/fr/') then 'allow' when rule_ is not null then 'block'
  when canonical in (select listed from l) then 'block' else 'allow' end verdict from r"""

ORACLE_SQL: dict[str, str] = {"op6_mixing": _MIXING, "op9_url_filter": _URLS}
