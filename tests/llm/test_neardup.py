import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tidewater.llm import neardup
from tidewater.llm.components import components


def shingles(text, width=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows, percent):
    """component of each id by comparing all pairs."""
    sets = {}
    for i, t in rows:
        sets.setdefault(i, shingles(t))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            union = len(sets[a] | sets[b])
            if union and 100 * both >= percent * union:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def family(rng, size, words, edits):
    base = [f"v{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(size):
        copy = list(base)
        for _ in range(rng.randrange(edits)):
            copy[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def test_components_equal_brute_force(spark, make_docs):
    rng = random.Random(3)
    texts = family(rng, 60, 120, 6) + family(rng, 25, 40, 3) + [" ".join(f"u{rng.randrange(800)}" for _ in range(rng.randrange(1, 60))) for _ in range(80)]
    texts += texts[:10] + ["short one", "short one", "Short  ONE", "x"]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = neardup.near_duplicates(make_docs([(i, t, "en", "s") for i, t in rows]), 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute(rows, 85)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(shingles(t)) for i, t in rows}


def test_crowded_keys_are_resolved_in_blocks(spark, make_docs, monkeypatch):
    rng = random.Random(5)
    rows = list(enumerate(family(rng, 90, 150, 14)))
    crossing = neardup._crossing
    asked = []
    monkeypatch.setattr(neardup, "_crossing", lambda *a: asked.append(a[-1]) or crossing(*a, block=16, few=0))
    got = neardup.near_duplicates(make_docs([(i, t, "en", "s") for i, t in rows]), 85)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == brute(rows, 85)
    assert asked == [True, False]


def test_a_crowded_key_of_one_family_costs_its_strangers_only(spark):
    n, slots = 4000, 32
    placed = spark.range(n).select(F.lit(1).cast("long").alias("key"), F.lit(0).alias("slot"), "id", F.when(F.col("id") < n - 3, 0).otherwise(F.col("id")).cast("long").alias("comp"))
    sig = np.arange(slots, dtype=np.uint16).tobytes()
    reps = spark.range(n).select("id", F.lit(bytearray(sig)).alias("sig"))
    wide = spark.range(n).select("id", F.lit(bytearray(neardup.WIDE)).alias("wide"), F.lit(100).cast("long").alias("size"))
    for nearest, pairs in ((True, 3 + 2), (False, 3 * (n - 3) + 3)):  # each stranger with the family, and with another one
        got = neardup._crossing(placed, reps, wide, slots, 15, 85, nearest)
        assert got.count() == pairs
    sent = neardup._mixed(placed).first()
    assert (sent["main"], sent["n"], sent["s"]) == (0, n, 3)


def test_gathered_keys_give_the_pairs_of_single_ones():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 16, 32).astype(np.uint16)
    n = 40
    sigs = np.where(rng.random((n, 32)) < 0.15, rng.integers(0, 1 << 16, (n, 32)), base).astype(np.uint16)
    comp = rng.integers(0, 6, n)
    main = np.bincount(comp).argmax()
    rows = {"id": np.arange(n), "comp": comp, "size": rng.integers(90, 110, n), "sig": [x.tobytes() for x in sigs], "wide": [bytes(neardup.WIDE)] * n}

    def of(at, asks, key):
        table = {k: [v[i] for i in at] for k, v in rows.items()} | {"asks": asks, "key": key, "slot": [0] * len(at), "main": [main] * len(at)}
        return neardup._Members(neardup.pa.table(table), 32, 15, 85)

    strangers = [i for i in range(n) if comp[i] != main]
    one = of(strangers + [*range(n)], [True] * len(strangers) + [False] * n, [7] * (n + len(strangers)))
    many = of([*range(n)] * 2, [False] * (2 * n), [7] * n + [8] * n)
    pairs = lambda t: {(min(a, b), max(a, b)) for a, b in zip(t["a"].to_pylist(), t["b"].to_pylist())}
    want = pairs(one.pairs(one.under_one_key(), False))
    assert len(want) > 50 and pairs(many.pairs(many.under_many_keys(), False)) == want
    assert 0 < len(pairs(one.pairs(one.under_one_key(), True))) <= 2 * len(strangers)


def test_ids_that_repeat_with_other_texts(make_docs):
    """Each row is a document: a second, unrelated text under an id changes nothing."""
    rng = random.Random(11)
    texts = family(rng, 60, 100, 12)
    other = [" ".join(f"o{rng.randrange(10**6)}" for _ in range(60)) for _ in texts]
    want = brute(list(enumerate(texts)), 85)
    assert 1 < len(set(want.values())) < 60
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(i, t, "en", "s") for i, t in enumerate(other)]
    rows += rows[:20]  # and repeated rows
    got = neardup.near_duplicates(make_docs(rows), 85).collect()
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r["component_id"])
    for i in want:
        assert sorted(by[i]) == sorted([want[i]] * (2 if i < 20 else 1) + [i])


def test_odd_rows(odd_docs):
    got = neardup.near_duplicates(odd_docs, 85).collect()
    assert len(got) == odd_docs.count()
    by = {r["doc_id"]: r for r in got}
    assert by[None]["component_id"] is None and by[None]["kept"]
    assert by[1]["n_shingles"] == by[2]["n_shingles"] == by[3]["n_shingles"] == 0
    assert [by[i]["component_id"] for i in (1, 2, 3, 5, 6, 8, 9, 4)] == [1, 2, 3, 5, 5, 8, 8, 4]
    assert by[7]["n_shingles"] == 1 and by[8]["n_shingles"] == 8


def test_empty_table(make_docs):
    assert neardup.near_duplicates(make_docs([(1, "a", "en", "s")]).limit(0), 85).count() == 0


def test_plan_guarantees_the_distance():
    for similarity in (0.8, 0.85):
        chunks = neardup.plan_chunks(similarity)
        rng = np.random.default_rng(1)
        a = rng.integers(0, 1 << 16, (200, 4 * chunks)).astype(np.uint16)
        b = a.copy()
        for k in range(len(a)):  # as many errors as are allowed, anywhere
            at = rng.choice(4 * chunks, 2 * chunks - 1, replace=False)
            b[k, at] ^= 1
        assert (neardup.chunk_keys(a) == neardup.chunk_keys(b)).any(axis=1).all()


def test_first_shared_key():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 16, (300, 32)).astype(np.uint16)
    b = np.where(rng.random(a.shape) < 0.6, a ^ 1, a)
    same = neardup.chunk_keys(a) == neardup.chunk_keys(b)
    want = np.where(same.any(axis=1), same.argmax(axis=1), 32)
    assert (neardup.first_shared(a, b) == want).all() and (want == 32).any()


def test_component_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(1, 60)] + [(100, 200), (200, 300), (7, 7)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(edges).collect()}
    assert set(got.values()) == {1, 100} and got[60] == 1 and got[300] == 100
