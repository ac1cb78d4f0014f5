import random

from tidewater.llm import decontam


def index(seed=1, n=60):
    rng = random.Random(seed)
    words = [f"w{k}".encode() for k in range(150)]
    return decontam.BlockMaxIndex([[rng.choice(words) for _ in range(rng.randrange(3, 40))] for _ in range(n)]), rng


def test_block_max_wand_equals_brute_force():
    ix, rng = index()
    for _ in range(300):
        terms = rng.sample(range(len(ix.term)), rng.randrange(0, 60))
        for theta in (0.2, 0.4, 0.7):
            want = {}
            for t in terms:
                for docs, weights in ix.lists[t].values():
                    for d, w in zip(docs, weights):
                        want[d] = want.get(d, 0) + w
            want = {d: w for d, w in want.items() if w >= theta - 1e-6}
            got = dict(ix.search(terms, theta))
            assert set(got) == set(want) and all(abs(got[d] - want[d]) < 1e-9 for d in got)


def test_passage_bounds_lose_nothing():
    ix, rng = index(2, 40)
    items = [(k, b" ".join(rng.choices(list(ix.term), k=rng.randrange(5, 30))).decode()) for k in range(40)]
    m = decontam.Matcher(items, 0.5, 0.0)
    texts = [[rng.choice(list(ix.term)) for _ in range(rng.randrange(0, 300))] for _ in range(30)]
    got = m.matches(texts)
    for words, found in zip(texts, got):
        want = set()
        for p in range(0, max(1, -(-len(words) // m.stride))):
            ids = [m.index.term[w] for w in words[p * m.stride : (p + 2) * m.stride]]
            want |= {m.owner[e] for e, _ in m.index.search([t for t in ids if t >= 0], 0.5)}
        assert set(found) == want


def test_planted_items_are_found_and_others_not(spark, make_docs, odd_docs):
    rng = random.Random(4)
    word = lambda: f"q{rng.randrange(3000)}"
    long = " ".join(word() for _ in range(400)) + ". " + " ".join(word() for _ in range(9)) + "."
    items = [(k, " ".join(word() for _ in range(20)) + ". " + " ".join(word() for _ in range(8)) + ".") for k in range(30)]
    items += [(100, long), (101, None), (102, ""), (103, "..."), (None, items[3][1]), (4, items[4][1])]
    bench = spark.createDataFrame([(i, t, 9) for i, t in items], "item_id long, text string, doc_id int")
    docs, want = [], set()
    for i in range(200):
        body = [word() for _ in range(rng.randrange(0, 500))]
        if i % 5 == 0:
            k = rng.choice([*range(30), 100])
            at = rng.randrange(len(body) + 1)
            body[at:at] = (long if k == 100 else dict(items[:30])[k]).upper().replace(".", " ,").split()
            want.add((i, k))
            want |= {(i, None)} if k == 3 else set()
        docs.append((i, " ".join(body), "en", "s"))
    got = decontam.contaminated(make_docs(docs), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want
    assert all(r["overlap"] >= 0.5 and r["score"] >= 0.5 for r in got)
    assert decontam.contaminated(odd_docs, bench).count() == 0
    assert decontam.contaminated(odd_docs.limit(0), bench).count() == 0
    assert decontam.contaminated(odd_docs, bench.limit(0)).count() == 0
    # a question without its answer is no leak
    part = items[0][1].split(". ")[0]
    assert decontam.contaminated(make_docs([(1, part + " and so on", "en", "s")]), bench).count() == 0


def test_scores_do_not_depend_on_the_cut(spark, make_docs, monkeypatch):
    rng = random.Random(8)
    word = lambda: f"z{min(int(rng.expovariate(0.01)), 900)}"
    items = [(k, " ".join(word() for _ in range(rng.randrange(6, 40))) + ". " + " ".join(word() for _ in range(8)) + ".") for k in range(120)]
    items += [(500, " ".join(word() for _ in range(300)))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = []
    for i in range(150):
        text = [word() for _ in range(rng.randrange(0, 200))]
        own = rng.choice(items)[1].split()
        text[5:5] = own[: rng.randrange(len(own) // 2, len(own) + 1)]
        docs.append((i, " ".join(text), "en", "s"))
    docs = make_docs(docs)
    found = lambda: sorted((r["doc_id"], r["item_id"], round(r["score"], 9), round(r["overlap"], 9)) for r in decontam.contaminated(docs, bench, theta=0.4).collect())
    whole = found()
    assert len(whole) > 25
    monkeypatch.setattr(decontam, "INDEX_ITEMS", 7)
    assert found() == whole
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 1)  # a pass for each index
    assert found() == whole
    left = decontam.without_items(docs, bench, theta=0.4)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == set(range(150)) - {r[0] for r in whole}


def test_long_items_are_verified_where_they_were_found(spark, make_docs):
    rng = random.Random(9)
    words = [f"y{k}" for k in range(400)]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    filler = lambda n: [f"f{rng.randrange(10**6)}" for _ in range(n)]
    whole = filler(1000) + words + filler(1000)
    scattered = []  # the first entry, and the trigrams of the rest all over a long document
    scattered += words[:128]
    for k in range(128, 400, 4):
        scattered += filler(200) + words[k : k + 4]
    docs = make_docs([(1, " ".join(whole), "en", "s"), (2, " ".join(scattered), "en", "s")])
    assert [(r["doc_id"], r["overlap"]) for r in decontam.contaminated(docs, bench).collect()] == [(1, 1.0)]


def test_parts_of_one_and_two_words(spark, make_docs):
    answer = "the tall ship sailed past nine islands."
    bench = spark.createDataFrame([(1, "Beber. " + answer), (2, "Inou on. " + answer.replace("ship", "boat")), (3, "Oninhe."), (4, "Vato kesi.")], "item_id long, text string")
    around = "some words before {} and some words after it"
    texts = ["beber the tall ship sailed past nine islands", "inou on the tall boat sailed past nine islands", "oninhe", "vato kesi", "on inou the tall boat sailed past nine islands", "kesi vato", "vato and kesi"]
    docs = make_docs([(k, around.format(t), "en", "s") for k, t in enumerate(texts)] + [(10, "vato kesi", "en", "s"), (11, "vato", "en", "s")])
    assert sorted((r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, bench).collect()) == [(0, 1), (1, 2), (2, 3), (3, 4), (10, 4)]
