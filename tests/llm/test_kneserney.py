import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import kneserney
from tidewater.llm.tokens import U64, WordHasher


class Plain:
    """The same model with dictionaries."""

    def __init__(self, texts, order):
        self.order, self.count, self.raw = order, [None] + [Counter() for _ in range(order)], Counter()
        for t in texts:
            seq = self.words(t)
            for i in range(order - 1, len(seq)):
                self.count[order][tuple(seq[i - order + 1 : i + 1])] += 1
                self.raw[seq[i]] += 1
        for k in range(order - 1, 0, -1):
            self.count[k] = Counter(g[1:] for g in self.count[k + 1])
        self.after = [None] + [defaultdict(list) for _ in range(order)]
        for k in range(1, order + 1):
            for g, c in self.count[k].items():
                self.after[k][g[:-1]].append(c)
        tally = lambda c: [sum(x == k for x in c.values()) for k in (1, 2, 3, 4)]
        self.d = [None] + [[0, *kneserney.discounts(tally(self.count[k]))] for k in range(1, order + 1)]
        self.size, self.tokens = len(self.raw), sum(self.raw.values())

    def words(self, text):
        return ["<s>"] * (self.order - 1) + (text or "").encode().lower().split() + ["</s>"]

    def prob(self, gram):
        k = len(gram)
        lower = self.prob(gram[1:]) if k > 1 else 1 / (self.size + 1)
        follow, d = self.after[k].get(gram[:-1]), self.d[k]
        if not follow:
            return lower
        left = sum(d[min(c, 3)] for c in follow)
        c = self.count[k].get(gram, 0)
        return (max(c - d[min(c, 3)], 0) + left * lower) / sum(follow)

    def score(self, text):
        seq, n = self.words(text), self.order - 1
        own = sum(math.log10(self.prob(tuple(seq[i - n : i + 1]))) for i in range(n, len(seq)))
        base = sum(math.log10((self.raw.get(w, 0) + 1) / (self.tokens + self.size + 1)) for w in seq[n:])
        return len(seq) - n, sum(w in self.raw for w in seq[n:]), base, own


def corpus(seed, n, follow):
    """Texts in which a word mostly depends on the two before it."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        text = []
        for _ in range(rng.randrange(0, 50)):
            text.append(f"t{(hash_of(text[-2:]) + rng.randrange(2)) % 40}" if rng.random() < follow else f"t{min(int(rng.expovariate(0.15)), 60)}")
        out.append(" ".join(text))
    return out


def hash_of(words):
    return sum(ord(c) * (7 * k + 1) for k, w in enumerate(words) for c in w)


@pytest.mark.parametrize("order", [2, 3, 4])
def test_equals_a_plain_model(make_docs, order):
    texts = corpus(7, 200, 0.5) + [None, "", "NEW Unseen t1", "t1 T2"]
    docs = make_docs([(i, t, "en", "s") for i, t in enumerate(texts)])
    want = Plain([t for i, t in enumerate(texts) if i % 3], order)
    got = kneserney.perplexity(docs, F.col("doc_id") % 3 != 0, order=order).collect()
    assert len(got) == len(texts)
    for r in got:
        n, known, base, own = want.score(texts[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, want.tokens)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(own, rel=1e-9)


def test_probabilities_add_up():
    for order in (2, 3):
        plain = Plain(corpus(1, 60, 0.7), order)
        words = [*plain.raw, "unseen"]
        for context in [*list(plain.after[order])[:40], ("t1",) * (order - 1), ("unseen",) * (order - 1)]:
            assert sum(plain.prob((*context, w)) for w in words) == pytest.approx(1)


def test_a_higher_order_predicts_better(make_docs):
    texts = corpus(3, 900, 0.95)
    docs = make_docs([(i, t, "en", "s") for i, t in enumerate(texts)])
    per_token = {}
    for order in (2, 3):
        rows = kneserney.perplexity(docs, F.col("doc_id") % 5 != 0, order=order).where("doc_id % 5 = 0").collect()
        per_token[order] = sum(r["score"] for r in rows) / sum(r["n_tokens"] for r in rows)
    assert per_token[3] > per_token[2]
    with pytest.raises(ValueError):
        kneserney.train(docs, 1)


def test_packets():
    words = [np.array(x, np.uint64) for x in ([5, 5, 9, 5], [1, 1, 2, 3], [7, 7, 7, 8])]
    packets = [p for _, p in kneserney.count_grams(words, 2)] + [p for _, p in kneserney.count_grams([w[:1] for w in words], 2)]
    h, got, (counts,) = kneserney.merge(packets, 3)
    assert (np.diff(h.astype(float)) > 0).all()
    assert sorted(zip(*(w.tolist() for w in got), counts.tolist())) == [(5, 1, 7, 3), (5, 3, 8, 1), (9, 2, 7, 1)]
    words, facts = kneserney.shorter(got, counts, counts)
    by = {(a, b): [int(f[i]) for f in facts] for i, (a, b) in enumerate(zip(*(w.tolist() for w in words)))}
    assert by == {(5, 1): [3, 0, 0, 1, 0, 0], (5, 3): [1, 1, 0, 0, 0, 0], (9, 2): [1, 1, 0, 0, 0, 0], (1, 7): [0, 0, 0, 0, 3, 1], (3, 8): [0, 0, 0, 0, 1, 1], (2, 7): [0, 0, 0, 0, 1, 1]}


def test_sequences():
    h, n = np.arange(10, 17, dtype=U64), np.array([3, 0, 4, 0])
    for order in (2, 3, 5):
        full, tokens = kneserney.sequences(h, n, order)
        want, at = [], 0
        for k in n:
            want += [kneserney.START] * (order - 1) + list(h[at : at + k]) + [kneserney.END]
            at += k
        assert full.tolist() == [int(x) for x in want] and (full[tokens] != kneserney.START).all() and len(tokens) == n.sum() + len(n)
    assert WordHasher()([b"a"]).dtype == U64


def test_odd_rows_and_no_training_rows(odd_docs):
    got = kneserney.perplexity(odd_docs, F.col("doc_id") > 4).collect()
    assert len(got) == odd_docs.count() and all(r["score"] <= 0 for r in got)
    none = kneserney.perplexity(odd_docs, F.lit(False)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["score"] == 0 and r["base_score"] == 0 for r in none)
    assert kneserney.perplexity(odd_docs.limit(0), F.lit(True)).count() == 0
