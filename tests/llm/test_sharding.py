import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from tidewater.llm import sharding


def test_lpt_is_largest_first_to_the_least_loaded():
    placed = sharding.lpt([(5, "a"), (4, "b"), (3, "c"), (3, "d"), (3, "e")], 2)
    assert placed == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 1}
    assert sharding.lpt([], 3) == {}


def test_documents(make_docs):
    rng = random.Random(1)
    texts = ["t" * rng.randrange(1, 400) + str(rng.randrange(400)) for _ in range(1500)] + ["same text"] * 200
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    got = sharding.shard_documents(make_docs(rows), 8).collect()
    load, slots, where = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in got:
        text = texts[r["doc_id"]]
        assert r["size"] == len(text.encode()) + 1 and r["text_crc32"] == zlib.crc32(text.encode())
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        where[text].add(r["shard"])
    assert all(len(v) == 1 for v in where.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert set(load) == set(range(8)) and max(load.values()) - min(load.values()) <= 0.01 * sum(load.values())


def test_classes_equal_plain_lpt():
    for seed in range(60):
        rng = random.Random(seed)
        shards = rng.randrange(1, 9)
        sizes = [rng.randrange(1, rng.choice([3, 20, 300])) for _ in range(rng.randrange(0, 900))]
        placed = sharding.lpt([(s, k) for k, s in enumerate(sizes)], shards)
        classes = sorted(set(sizes), reverse=True)
        want = np.zeros((len(classes), shards), int)
        for k, s in enumerate(sizes):
            want[classes.index(s), placed[k]] += 1
        got = sharding.lpt_classes(np.array(classes, int), np.array([sizes.count(s) for s in classes], int), shards)
        assert (got == want).all()


def test_every_group_is_scheduled_by_its_size(make_docs):
    rng = random.Random(4)
    texts = [f"{rng.randrange(10**9)}" + "t" * int(rng.expovariate(0.02)) for _ in range(900)]
    texts += [rng.choice(texts) for _ in range(600)] + ["copy"] * 500 + [None, None, "", ""]
    got = sharding.shard_documents(make_docs([(i, t, "en", "s") for i, t in enumerate(texts)]), 7).collect()
    size = lambda t: len((t or "").encode()) + 1
    groups = Counter()
    for t in texts:
        groups[t] += size(t)
    placed = sharding.lpt([(s, repr(t)) for t, s in groups.items()], 7)
    want = [Counter() for _ in range(7)]  # sizes of the groups in each shard; equal ones are interchangeable
    for t, s in groups.items():
        want[placed[repr(t)]][s] += 1
    have, seen = [Counter() for _ in range(7)], {}
    for r in got:
        seen[texts[r["doc_id"]]] = r["shard"]
    for t, shard in seen.items():
        have[shard][groups[t]] += 1
    assert have == want
    assert all(seen[texts[r["doc_id"]]] == r["shard"] for r in got)


def test_odd_rows_and_empty_table(odd_docs):
    got = sharding.shard_documents(odd_docs).collect()
    assert len(got) == odd_docs.count()
    null = next(r for r in got if r["doc_id"] == 1)
    assert null["size"] == 1 and null["text_crc32"] is None and null["grown_shard"] is None
    assert len({r["shard"] for r in got if r["doc_id"] in (8, 9)}) == 1
    assert sharding.shard_documents(odd_docs.limit(0)).count() == 0
