"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept and returns a DataFrame; all but the last return the columns of documents,
whatever these are called.  Rows are judged one by one: null and repeated ids
lose nothing and multiply nothing.  Empty tables pass through every stage.
Stages that hand texts to Python bound the batches of the session (``small_batches``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import decontam, mixing, neardup, quality, rowkeys, scratch, sharding
from tidewater.llm.labelled import fold
from tidewater.llm.tokens import small_batches


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.  Null and empty texts
    are scored by their structure; rows of equal text and metadata fare alike; a
    null id is no training row.  Without usable labels all documents stay."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score, fine = rowkeys.free(docs.columns, "score", "predicted")
    scored = quality.quality(docs, labels, fold(F.col("doc_id"), 5) != 0, keep=tuple(docs.columns), names=(score, fine))
    return scored.where(F.col(fine) == 1).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays, the first of the written
    input.  Texts are compared, whatever their ids, so repeated rows are copies
    of one another.  Null and empty texts, and texts without words, are
    near-duplicates of nothing: they all stay."""
    small_batches(spark)
    key, kept = rowkeys.free(docs.columns, "row", "kept")
    rows = rowkeys.numbered(docs, key)
    found = neardup.near_duplicates(rows.select(F.col(key).alias("doc_id"), "text"), percent=80)
    judged = found.select(F.col("doc_id").alias(key), F.col("kept").cast("int").alias(kept))
    return rowkeys.attach(rows, key, judged, kept).where(F.col(kept) == 1).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go, by their texts, whatever their ids.
    Null and empty texts hold none."""
    small_batches(spark)
    return decontam.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it.  Null ids and repeated ids are rows
    like others; a null source is a source of its own; texts without words have
    size 0 and are taken as others of their source are."""
    key, size, copies = rowkeys.free(docs.columns, "row", "words", "copies")
    rows = rowkeys.numbered(docs, key, **{size: mixing.word_count(F.col("text"))})
    narrow = rows.select("doc_id", "source", F.col(size).alias("size"), F.col(key).alias("row_key"))
    taken = mixing.sample_to_targets(narrow, keep=("row_key",))
    taken = taken.select(F.col("row_key").alias(key), F.col("copies").alias(copies))
    chosen = rowkeys.attach(rows, key, taken, copies).where(F.col(copies) > 0)
    again = F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))).alias(size)
    return chosen.select(*docs.columns, again).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of each row.
    Equal texts share a shard, null texts likewise; null ids come first."""
    return sharding.shard_documents(docs)


STAGES = [
    ("quality classifier", classify_quality),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: The classifier and the schedule have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
