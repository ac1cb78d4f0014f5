"""Language of web pages by Bayesian evidence fusion.

Evidence, each a likelihood for each language:

* the text: a multinomial model of hashed byte trigrams, learned from a bounded
  sample of texts of known language.  Trigrams of a text depend on each other,
  so its log likelihood is divided by ``temper``;
* the declared language of the markup: how often pages of a language declare
  which one, from a first pass (grouped aggregation, smoothed);
* the address suffix: how often pages of a language have it, likewise;
* the host: a prior smoothed over its registered domain and its suffix, from
  grouped aggregation of the first pass.  A page's own contribution is taken
  out of its host's counts.

Markup is read in one linear pass over the whole page, however it is broken.

Nulls: a null or empty page or address gives no evidence of its kind; a page
without any evidence gets the overall shares of the languages.  Very long pages
are read whole.  Repeated rows are pages of their own; of languages with equal
probability the first by name wins.  Without known languages the result is
empty of languages: lang is null and probability 0.  Only page_id, url and html
are looked at, whatever other columns there are.  An empty table gives an empty
result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import scratch
from .labelled import first_by_hash
from .tokens import as_bytes, slices
from .urlfilter import host_of

BITS = 15
_NAME = re.compile(rb"(script|style)\b", re.I)
_CLOSE = {k: re.compile(rb"</" + k + rb"\s*>", re.I) for k in (b"script", b"style")}
_HTML = re.compile(rb"<html\b", re.I)
_LANG = re.compile(rb"\blang\s*=\s*[\"']?([A-Za-z]{2,3})", re.I)
#: Labels below which a country's registry gives out domains, as in ``x.co.uk``.
REGISTRY = ("ac", "co", "com", "edu", "gov", "ne", "net", "or", "org")
DOMAIN = rf"([^.]+\.(?:{'|'.join(REGISTRY)})\.[a-z]{{2}}|[^.]+\.[^.]+)$"


def parse(html: bytes) -> tuple[bytes, str | None]:
    """The text between the tags, without scripts, styles and comments, and the
    language that an ``html`` tag declares, wherever in the page.  What is opened
    and never closed counts as a tag, or without ``>`` as text.  Each search for
    an end goes on from the last, so the time is linear in the page."""
    out, at, said, ends = [], 0, None, {}

    def closes(kind: bytes, begin: int) -> int:
        """Where the first end of this kind at or after ``begin`` ends; -1: nowhere."""
        found = ends.get(kind)
        if found is None or -1 < found[0] < begin:
            if kind == b"-->":
                k = html.find(kind, begin)
                found = (k, k + 3) if k >= 0 else (-1, -1)
            else:
                m = _CLOSE[kind].search(html, begin)
                found = m.span() if m else (-1, -1)
            ends[kind] = found
        return found[1]

    while (i := html.find(b"<", at)) >= 0:
        out.append(html[at:i])
        end = -1
        if html.startswith(b"<!--", i):
            end = closes(b"-->", i + 4)
        elif m := _NAME.match(html, i + 1):
            end = closes(m[1].lower(), m.end())
        if end < 0:
            end = html.find(b">", i) + 1
            if not end:  # no tag ends any more
                m = None if said else _HTML.search(html, i)
                said = said or (_LANG.search(html, m.end()) if m else None)
                at = i
                break
            if not said and _HTML.match(html, i):
                said = _LANG.search(html, i, end)
        out.append(b" ")
        at = end
    return b"".join([*out, html[at:]]), said[1].decode().lower() if said else None


def visible(html: bytes) -> bytes:
    return parse(html)[0]


def declared(html: bytes) -> str | None:
    return parse(html)[1]


def trigrams(text: bytes) -> np.ndarray:
    """Counts of hashed byte trigrams, whitespace and digits folded."""
    if not text:
        return np.zeros(1 << BITS, np.int64)
    b = np.frombuffer(re.sub(rb"[\s\d]+", b" ", b" " + text.lower() + b" "), np.uint8).astype(np.uint32)
    h = (b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA77) ^ b[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
    return np.bincount(h >> np.uint32(32 - BITS), minlength=1 << BITS)


def learn_text(sample: DataFrame, alpha: float = 0.05) -> tuple[list[str], np.ndarray]:
    """Languages and (trigrams, languages) log probabilities from text, lang."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in slices(batches, "text"):
            for text, lang in zip(as_bytes(b.column("text")), b.column("lang").to_pylist()):
                sums[lang] = sums.get(lang, 0) + trigrams(text or b"")
        for lang, counts in sorted(sums.items()):
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([counts], pa.list_(pa.int64()))], ["lang", "counts"])

    got: dict[str, np.ndarray] = {}
    for r in sample.select("lang", "text").mapInArrow(count, "lang string, counts array<long>").toLocalIterator():
        got[r["lang"]] = got.get(r["lang"], 0) + np.array(r["counts"], np.float64)  # a row for each language and task
    langs = sorted(got)
    table = np.stack([np.log((got[x] + alpha) / (got[x].sum() + alpha * (1 << BITS))) for x in langs], axis=1) if langs else np.zeros((1 << BITS, 0))
    return langs, table


def evidence(pages: DataFrame, langs: list[str], table: np.ndarray, temper: float) -> DataFrame:
    """page_id, host, domain, suffix, declared and text (log likelihoods)."""
    shared = pages.sparkSession.sparkContext.broadcast(table.astype(np.float32))  # 2**BITS rows
    host = F.nullif(F.regexp_replace(host_of(F.col("url")), r":\d+$", ""), F.lit(""))
    rows = pages.select(F.col("page_id").alias("page_id"), host.alias("host"), F.col("html").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "__text"):
            said, text = [], []
            for html in as_bytes(b.column("__text")):
                words, lang = parse(html or b"")
                said.append(lang)
                counts = trigrams(words.strip())
                at = np.flatnonzero(counts)
                text.append((counts[at] @ shared.value[at]) / temper)
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("host"), pa.array(said, pa.string()), pa.array(text, pa.list_(pa.float64()))], ["page_id", "host", "declared", "text"])

    schema = rows.select("page_id", "host").withColumns({"declared": F.lit(None).cast("string"), "text": F.array(F.lit(0.0))}).schema
    found = rows.mapInArrow(run, schema)
    suffix = F.regexp_extract("host", r"([^.]+)$", 1)
    domain = F.regexp_extract("host", DOMAIN, 1)
    return found.select("page_id", "host", F.nullif(domain, F.lit("")).alias("domain"), F.nullif(suffix, F.lit("")).alias("suffix"), "declared", "text")


def _softmax(logs: Column) -> Column:
    powers = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda a, y: a + y))


def _add(*arrays: Column) -> Column:
    out = arrays[0]
    for a in arrays[1:]:
        out = F.zip_with(out, a, lambda x, y: x + y)
    return out


def _sums(n: int, prob: str, name: str) -> Column:
    return F.array(*[F.sum(F.col(prob)[k]) for k in range(n)]).alias(name)


def identify(pages: DataFrame, known: DataFrame, rows: int = 4000, temper: float = 20.0, alpha: float = 4.0) -> DataFrame:
    """page_id, host, declared, lang, probability, lang_by_text.  ``known``:
    text, lang (and doc_id), of which ``rows`` in a hash order are learned from."""
    usable = known.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    chosen = first_by_hash(usable.select("doc_id"), "doc_id", rows).distinct()
    sample = usable.select("doc_id", "lang", "text").join(F.broadcast(chosen), "doc_id")  # ``rows`` ids at most
    langs, table = learn_text(sample)
    n = len(langs)
    if not n:
        return pages.select("page_id", host_of(F.col("url")).alias("host"), F.lit(None).cast("string").alias("declared"), F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("probability"), F.lit(None).cast("string").alias("lang_by_text"))
    found = scratch.table(evidence(pages, langs, table, temper).withColumn("p", F.expr("text")), "evidence").withColumn("p", _softmax(F.col("text")))

    total = found.agg(_sums(n, "p", "s")).first()["s"]  # one row
    shares = np.array([x or 0.0 for x in total])
    shares = (shares + alpha / n) / (shares.sum() + alpha)
    overall = F.array(*[F.lit(float(x)) for x in shares])

    found = found.withColumn("n", F.monotonically_increasing_id())
    joined = found
    for column, name in (("declared", "said"), ("suffix", "near_suffix"), ("domain", "near_domain"), ("host", "near_host")):
        sums = found.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("k")).agg(_sums(n, "p", name))
        # pages without such evidence carry keys of their own, so that no task gets them all
        key = F.coalesce(F.col(column), F.concat(F.lit("\x00"), F.col("n").cast("string")))
        joined = joined.withColumn("j", key).join(scratch.table(sums, name), F.col("j") == F.col("k"), "left").drop("j", "k")

    zero = F.array(*[F.lit(0.0)] * n)

    def minus(name: str) -> Column:
        """The sums without the page's own part."""
        return F.zip_with(F.coalesce(F.col(name), zero), F.col("p"), lambda s, x: F.when(F.col(name).isNull(), F.lit(0.0)).otherwise(F.greatest(s - x, F.lit(0.0))))

    def prior(counts: Column, parent: Column) -> Column:
        size = F.aggregate(counts, F.lit(0.0), lambda a, y: a + y)
        return F.zip_with(counts, parent, lambda c, q: (c + F.lit(alpha) * q) / (size + F.lit(alpha)))

    # of the address: suffix, within it the domain, within it the host
    joined = joined.withColumn("q1", prior(minus("near_suffix"), overall))
    joined = joined.withColumn("q2", prior(minus("near_domain"), F.col("q1")))
    joined = joined.withColumn("q3", prior(minus("near_host"), F.col("q2")))
    # P(said | lang) is proportional to P(lang | said) / P(lang)
    ratio = F.zip_with(prior(minus("said"), overall), overall, lambda x, y: F.log(x / y))
    joined = joined.withColumn("f", F.when(F.col("declared").isNull(), zero).otherwise(ratio))
    logs = _add(F.col("text"), F.col("f"), F.transform("q3", lambda x: F.log(x)))
    final = joined.withColumn("post", _softmax(logs))
    names = F.array(*[F.lit(x) for x in langs])
    best = lambda c: F.element_at(names, F.array_position(c, F.array_max(c)).cast("int"))
    return final.select("page_id", "host", "declared", best(F.col("post")).alias("lang"), F.array_max("post").alias("probability"), best(F.col("p")).alias("lang_by_text"))
