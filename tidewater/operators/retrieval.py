"""Text embedding, exact nearest neighbours in time, and what they resolved to."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import entity_key, split_entity_key
from .ranks import counted

Encoder = Callable[[list[str]], list[list[float]]]


def hashing_encoder(dims: int = 64) -> Encoder:
    """A small deterministic encoder: signed hashed words, scaled to length 1."""

    def encode(texts: list[str]) -> list[list[float]]:
        out = []
        for text in texts:
            v = [0.0] * dims
            for w in text.lower().split():
                h = zlib.crc32(w.encode())
                v[h % dims] += 1.0 if h & 0x80000000 else -1.0
            n = sum(x * x for x in v) ** 0.5 or 1.0
            out.append([x / n for x in v])
        return out

    return encode


def extract_texts(bronze: DataFrame, event_type: str = "PullRequestEvent", json_column: str = "raw_json") -> DataFrame:
    """entity_key, event_time, text_hash, text of opened entities whose title, body
    and ids are all present."""
    j = F.col(json_column)
    at = lambda path: F.get_json_object(j, path)
    node, kind = ("pull_request", "pr") if event_type == "PullRequestEvent" else ("issue", "issue")
    rows = bronze.where((at("$.type") == event_type) & (at("$.payload.action") == "opened"))
    rows = rows.select(
        entity_key(kind, at("$.repo.id"), at(f"$.payload.{node}.number")).alias("entity_key"),
        F.try_to_timestamp(at("$.created_at")).alias("event_time"),
        F.concat(at(f"$.payload.{node}.title"), F.lit("\n\n"), at(f"$.payload.{node}.body")).alias("text"),
        (at("$.repo.id").isNotNull() & at(f"$.payload.{node}.number").isNotNull()).alias("ok"),
    )
    rows = rows.where("ok and text is not null and event_time is not null")
    return rows.select("entity_key", "event_time", F.sha2("text", 256).alias("text_hash"), "text")


def pending(texts: DataFrame, embedded: DataFrame) -> DataFrame:
    """Entities not embedded yet (an entity with a text known from another one is
    pending too: it gets its own row)."""
    return texts.join(embedded.select("entity_key", "text_hash"), ["entity_key", "text_hash"], "left_anti")


def embed(texts: DataFrame, load: Callable[[], Encoder], batch: int = 256, partitions: int | None = None, limit: int | None = None) -> DataFrame:
    """entity_key, event_time, text_hash, embedding.  Each distinct text is encoded
    once; the encoder is loaded once a partition."""
    if limit is not None:
        texts = texts.orderBy("event_time", "entity_key").limit(limit)
    unique = texts.groupBy("text_hash").agg(F.first("text").alias("text"))
    unique = unique.repartition(partitions, "text_hash") if partitions else unique

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = None
        for frame in frames:
            for at in range(0, len(frame), batch):
                encoder = encoder or load()
                part = frame.iloc[at : at + batch]
                yield pd.DataFrame({"text_hash": part["text_hash"], "embedding": [list(map(float, v)) for v in encoder(part["text"].tolist())]})

    vectors = unique.mapInPandas(run, "text_hash string, embedding array<double>")
    return texts.drop("text").join(vectors, "text_hash").select("entity_key", "event_time", "text_hash", "embedding")


#: Rows of the vectors and of the queries in a group, at most (on average, by hash).
BLOCK, ASKED = 20_000, 2_000


def _usable(rows: DataFrame, columns: list[Column], vector: str) -> DataFrame:
    v = F.col(vector).cast("array<double>")
    return rows.select(*columns, v.alias("v")).where(F.col("v").isNotNull() & (F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x)))


def nearest_before(spine: DataFrame, vectors: DataFrame, k: int, query_key: str = "query_key") -> DataFrame:
    """spine: query_key, as_of, embedding; vectors: entity_key, event_time,
    embedding.  The k nearest vectors (Euclidean, ties to the smaller key) known
    strictly before each query's instant: query_key, entity_key, distance, rank.

    Exact, for a stated query set: every block of queries meets every block of the
    vectors of its length, as many blocks as the rows need, and only k rows of a
    query leave a pair of blocks.  Vectors that are null, empty or hold nulls or
    NaN, and rows with null keys or instants, take no part.
    """
    q = _usable(spine, [F.col(query_key).alias("q"), F.col("as_of").alias("t")], "embedding").where("q is not null and t is not null")
    v = _usable(vectors, [F.col("entity_key").alias("e"), F.col("event_time").alias("t")], "embedding").where("e is not null and t is not null")
    asked, blocks = max(1, -(-spine.count() // ASKED)), max(1, -(-vectors.count() // BLOCK))
    by = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    micros = F.unix_micros(F.col("t").cast("timestamp")).alias("t")
    left = q.select("q", micros, "v", F.size("v").alias("d"), by("q", asked).alias("a"), every(blocks).alias("b"))
    right = v.select("e", micros, "v", F.size("v").alias("d"), by("e", blocks).alias("b"), every(asked).alias("a"))
    schema = T.StructType([T.StructField("q", q.schema["q"].dataType), T.StructField("e", v.schema["e"].dataType), T.StructField("distance", T.DoubleType())])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        at, of, far = [], [], []
        if left.num_rows and right.num_rows:
            right = right.sort_by("e")  # ties go to the smaller key
            d = left["d"][0].as_py()
            x, y = (np.asarray(t["v"].combine_chunks().flatten()).reshape(-1, d) for t in (left, right))
            now, known = left["t"].to_numpy(), right["t"].to_numpy()
            keys, own = right["e"].to_numpy(), left["q"].to_numpy()
            for i in range(len(x)):
                rows = np.flatnonzero((known < now[i]) & (keys != own[i]))
                apart = np.sqrt(((y[rows] - x[i]) ** 2).sum(axis=1))
                best = np.flatnonzero(apart <= np.partition(apart, k - 1)[k - 1]) if len(rows) > k else np.arange(len(rows))
                best = best[np.argsort(apart[best], kind="stable")[:k]]
                at.append(np.full(len(best), i))
                of.append(rows[best])
                far.append(apart[best])
        join = lambda p, kind: np.concatenate(p).astype(kind) if p else np.zeros(0, kind)
        return pa.table({"q": left["q"].take(pa.array(join(at, np.int64))), "e": right["e"].take(pa.array(join(of, np.int64))), "distance": join(far, np.float64)})

    met = left.groupBy("d", "a", "b").cogroup(right.groupBy("d", "a", "b")).applyInArrow(meet, schema)
    rank = F.row_number().over(Window.partitionBy("q").orderBy("distance", "e"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("q").alias(query_key), F.col("e").alias("entity_key"), "distance", "rank")


def similarity_features(spine: DataFrame, neighbours: DataFrame, resolutions: DataFrame) -> DataFrame:
    """spine: repo_id, pr_number, as_of_timestamp.  similar_resolved_count and
    similar_breach_rate over the neighbours that were closed strictly before the
    spine's instant.  No neighbour: 0 and null."""
    key = entity_key("pr", F.col("repo_id"), F.col("pr_number"))
    ours = spine.select("repo_id", "pr_number", "as_of_timestamp", key.alias("query_key"))
    found = neighbours.withColumn("n", split_entity_key(F.col("entity_key"))).where("n is not null")
    other = resolutions.select(F.col("repo_id").alias("r"), F.col("pr_number").alias("p"), "closed_at", "breach")
    met = found.join(other, (F.col("n.repo_id") == F.col("r")) & (F.col("n.pr_number") == F.col("p")))
    rows = ours.join(met.select("query_key", "closed_at", "breach"), "query_key", "left")
    known = F.col("closed_at") < F.col("as_of_timestamp")
    return rows.groupBy("repo_id", "pr_number", "as_of_timestamp").agg(F.count_if(known & F.col("breach").isNotNull()).alias("similar_resolved_count"), F.avg(F.when(known, F.col("breach").cast("double"))).alias("similar_breach_rate"))


def hash_sample(rows: DataFrame, keys: list[str], n: int, seed: int = 0) -> DataFrame:
    """n rows in the order of the MD5 of seed and keys (nulls as a mark): the same
    whenever, and wherever, it is evaluated."""
    named = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in keys])
    return rows.orderBy(F.md5(named.cast("binary")), *keys).limit(n)


def every_nth(rows: DataFrame, n: int, order: list[str], offset: int = 0) -> DataFrame:
    """Every n-th row in the order of ``order`` (unique), counted from ``offset``.
    Ranks are sums of counts over ranges, so no task sorts all rows; ``order``
    begins with a number or an instant."""
    first = order[0]
    place = rows.withColumn("__v", F.col(first).cast("double") if not isinstance(rows.schema[first].dataType, (T.TimestampType, T.DateType)) else F.unix_micros(F.col(first).cast("timestamp")).cast("double"))
    starts = counted(place, "__v", []).select(F.col("__v").alias("__w"), "start")
    inside = F.row_number().over(Window.partitionBy("__v").orderBy(*order)) - 1
    ranked = place.join(starts, F.col("__v") == F.col("__w")).withColumn("__rank", F.col("start") + inside)
    return ranked.where((F.col("__rank") >= offset) & ((F.col("__rank") - offset) % n == 0)).select(*rows.columns)
