import random
import re
from collections import defaultdict

from tidewater.llm import mixing


def water_fill(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, targets, free = share * sum(sizes.values()), {}, set(names)
    while free:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > most * sizes[s]}
        if not over:
            return targets | {s: level * w[s] for s in free}
        for s in over:
            targets[s] = most * sizes[s]
            left -= targets[s]
        free -= over
    return targets


def test_targets_and_taken_words(make_docs):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 80)), "en", rng.choice(["b", "a", "a", "a", "a", "É", "Z", None, "zz"])) for i in range(3000)]
    rows += [(9000 + i, "one two", "en", "tiny") for i in range(5)]
    docs = make_docs(rows)
    got = mixing.mix(docs).collect()
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t))
    want, taken = water_fill(dict(sizes)), defaultdict(int)
    assert abs(sum(want.values()) - 1.5 * sum(sizes.values())) < 1e-6 * sum(sizes.values())
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(160, 0.02 * want[s])
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in got)


def test_copies_are_integer_crossings_in_order(spark, make_docs):
    rows = [(i, "a b", "en", "s") for i in range(400)] + [(1000 + i, "a", "en", "t") for i in range(100)]
    got = sorted((r for r in mixing.mix(make_docs(rows)).collect() if r["source"] == "s"), key=lambda r: r["doc_id"])
    each = got[0]["target"] / got[0]["source_size"]
    total, seen = 0, set()
    for k, r in enumerate(got, 1):  # the running sum never leaves the expected one by a whole copy
        total += r["copies"]
        seen.add(r["copies"])
        assert abs(total - k * each) < 1
    assert seen <= {int(each), int(each) + 1}


def test_odd_rows_and_empty_table(odd_docs):
    got = mixing.mix(odd_docs).collect()
    assert len(got) == odd_docs.count()
    sizes = {r["doc_id"]: r["size"] for r in got}
    assert (sizes[1], sizes[2], sizes[3], sizes[4], sizes[7]) == (0, 0, 0, 150_000, 4)
    assert mixing.mix(odd_docs.limit(0)).count() == 0
    nothing = mixing.mix(odd_docs.where("doc_id in (1, 2, 3)")).collect()
    assert all(r["taken"] == 0 and r["target"] == 0 for r in nothing)
