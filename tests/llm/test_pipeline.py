import random
import re
from collections import Counter


import corpus_pipeline
import pyarrow as pa
from pyspark.sql import functions as F
from test_mixing import water_fill
from test_neardup import brute
from tidewater.llm import mixing, queries, scratch, sharding


def words(rng, n):
    return " ".join(f"{rng.choice('bcdfglmnprst')}{rng.choice('aeiou')}{rng.choice('bcdfglmnprst')}{rng.randrange(60)}" for _ in range(n))


CLASHES = ("score", "predicted", "copies", "size", "rank", "row", "words", "kept", "__text", "__block", "__codes", "row_key", "id", "t", "item_id", "shard", "__row")


def test_nulls_repeats_clashes_long_texts_and_empty_tables(spark, tmp_path, make_docs):
    rng = random.Random(3)
    item = words(rng, 20)
    a, b, c, d, e, f, g = (words(rng, 40) for _ in range(7))
    leak = words(rng, 30) + " " + item + " " + words(rng, 30)
    long = words(rng, 40_000)
    rows = [(1, a), (1, b), (2, c), (3, d), (3, c), (None, e), (None, f), (None, f), (4, f + " x"), (5, None), (5, None), (None, None), (6, leak), (6, g), (None, leak + " y"), (7, long), (7, long), (8, ""), (8, " ")]
    docs = make_docs([(i, t, "en", f"src{k % 2}" if k % 5 else None) for k, (i, t) in enumerate(rows)]).select("doc_id", "text", "lang", "source", "n_chars")
    docs = docs.withColumns({x: F.lit(f"clash {x}") for x in CLASHES})
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(7)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    pairs = lambda df: Counter((r["doc_id"], r["text"]) for r in df.collect())

    def same(df):
        assert df.columns == docs.columns and all(r[x] == f"clash {x}" for r in df.collect() for x in CLASHES)
        return pairs(df)

    # one class of labels: no model, so everything stays
    assert same(corpus_pipeline.classify_quality(spark, docs, str(tmp_path))) == Counter(rows)

    # one row of each group stays, whatever the ids; a text goes with its own near copies only
    unique = same(corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path)))
    for group in ([a], [b], [c], [d], [e], [f, f + " x"], [g], [leak, leak + " y"], [long]):
        assert sum(n for (_, t), n in unique.items() if t in group) == 1
    assert sum(n for (_, t), n in unique.items() if not (t or "").strip()) == 5 and not unique - Counter(rows)

    assert same(corpus_pipeline.decontaminate(spark, docs, str(tmp_path))) == Counter(r for r in rows if item not in (r[1] or ""))

    mixed = corpus_pipeline.mix_sources(spark, docs, str(tmp_path))
    taken = Counter()
    for r in mixing.mix(docs).collect():
        taken[r["doc_id"], r["source"], r["size"]] += r["copies"]
    got = Counter((r["doc_id"], r["source"], len((r["text"] or "").split())) for r in mixed.collect())
    assert got == +taken and any(i is None for i, *_ in got) and not set(same(mixed)) - set(rows)

    sharded = corpus_pipeline.shard(spark, docs, str(tmp_path))
    assert Counter(r["doc_id"] for r in sharded.collect()) == Counter(i for i, _ in rows)

    for _, stage in corpus_pipeline.STAGES[:-1]:
        none = stage(spark, docs.limit(0), str(tmp_path))
        assert none.columns == docs.columns and none.count() == 0
    assert corpus_pipeline.shard(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_run_equals_its_parts_by_brute_force(spark, tmp_path, make_docs, monkeypatch):
    """Every stage after the classifier against plain Python, on what its predecessor kept."""
    rng = random.Random(6)
    rows, quality = [], {}
    for i in range(260):
        text, good = words(rng, rng.randrange(20, 60)), i % 5 != 0
        rows.append((i, text if good else " ".join(w + "%%%" for w in text.split()), "en", f"s{i % 3}"))
        quality[i] = int(good)
    items = [(k, words(rng, 24)) for k in range(4)]
    rows += [(1000 + k, rows[k * 7 + 1][1] + " tail", "en", "s0") for k in range(20)] + [(2000 + k, words(rng, 20) + " " + t, "en", "s1") for k, t in items]
    make_docs(rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, q, 0) for i, q in quality.items()], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept, table = [], scratch.table
    monkeypatch.setattr(scratch, "table", lambda df, name: [found := table(df, name), name in names and kept.append(found.collect())][0])
    names = [name.replace(" ", "-") for name, _ in corpus_pipeline.STAGES]
    sharded = corpus_pipeline.run(spark, str(tmp_path)).collect()
    good, unique, clean, mixed = kept
    assert {r["doc_id"] for r in good if r["doc_id"] < 1000} == {i for i, q in quality.items() if q}
    groups = brute([(r["doc_id"], r["text"]) for r in good], 80)
    assert sorted(groups[r["doc_id"]] for r in unique) == sorted(set(groups.values()))
    assert {r["doc_id"] for r in clean} == {r["doc_id"] for r in unique if not any(t in r["text"] for _, t in items)}
    sizes = Counter()
    for r in clean:
        sizes[r["source"]] += len(r["text"].split())
    targets, took = water_fill(dict(sizes)), Counter()
    for r in mixed:
        took[r["source"]] += len(r["text"].split())
    assert all(abs(took[s] - t) <= 120 for s, t in targets.items())
    assert Counter(r["doc_id"] for r in sharded) == Counter(r["doc_id"] for r in mixed)
    text_of, load = {r["doc_id"]: r["text"] for r in mixed}, Counter()
    for r in sharded:
        assert r["size"] == len(text_of[r["doc_id"]].encode()) + 1
        load[r["shard"]] += r["size"]
    group = Counter()
    for r in mixed:
        group[r["text"]] += len(r["text"].encode()) + 1
    placed, want = sharding.lpt([(s, t) for t, s in group.items()], 16), Counter()
    for t, s in group.items():
        want[placed[t]] += s
    assert load == want


def test_names():
    assert [n for n in queries.QUERIES if re.match(r"op\d+_", n)] and len(queries.QUERIES) == 10
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "near-duplicates", "decontamination", "mixing", "sharding"]


def test_texts_reach_python_in_small_batches(spark, tmp_path, make_docs):
    """A task holds its batch outside the heap, so 9 MB of texts must not be one batch."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    default = spark.conf.get(setting)
    spark.createDataFrame([(0, "no such item")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    few = make_docs([(1, "one two", "en", "a")]).select("doc_id", "text", "lang", "source", "n_chars")
    many = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("abcdefg "), 400).alias("text"))
    sizes = lambda: [r["n"] for r in many.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long").collect()]
    try:
        for stage in (corpus_pipeline.classify_quality, corpus_pipeline.drop_near_duplicates, corpus_pipeline.decontaminate):
            spark.conf.set(setting, default)
            out = stage(spark, few, str(tmp_path))
            assert sum(found := sizes()) > 9_000_000 and max(found) < 5_000_000 and out.count() == 1
        spark.conf.set(setting, "1m")  # the caller's lower bound stays
        corpus_pipeline.decontaminate(spark, few, str(tmp_path))
        assert max(sizes()) < 2_000_000
    finally:
        spark.conf.set(setting, default)
