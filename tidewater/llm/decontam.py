"""Benchmark decontamination with a BM25 index of the test items.

Every passage of every text is a query against an inverted index of the items.
Weights are divided by what an item scores against itself, so one threshold
``theta`` (a share of the item's own weight) serves all items.  Postings lie in
blocks of items with their largest weights, and block-max WAND retrieves all
items that reach ``theta``: no cap on their number.  The block bounds of many
passages are computed at once, and only blocks that can reach ``theta`` are opened.

Passages are ``2 * stride`` words long and start every ``stride`` words, where
``stride`` is the length of the longest index entry; items longer than
``MAX_ENTRY`` words are indexed in entries of that many words, so each entry
lies whole in some passage.

A retrieved item is verified in the passage: its last sentence counts as the
answer and what precedes it as the question; both must overlap in word
trigrams, or where one has fewer than three words, in all of its words as they
follow each other (an item of one sentence has a question only).  An item of
several entries is verified in the stretch of its own length around the passage
that one of its entries was found in.

The items are cut into indexes of about ``INDEX_ITEMS``.  All of them weigh terms
by the statistics of all items, which are counted in Spark, and use one stride,
so scores do not depend on the cut.  Indexes are broadcast together up to
``BROADCAST_BYTES`` for one pass over the documents; a larger benchmark takes a
pass for each such portion.

Nulls: null and empty texts and items without words match nothing.  Null ids
are returned as nulls.  Repeated documents each return their matches; repeated
items each match.  Ties in score are all kept.  Extra columns are not looked at;
``keep`` may name any, but item_id, score and overlap, which are added.  Empty
tables give an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import scratch
from .rowkeys import free
from .tokens import as_bytes, slices

MAX_ENTRY = 128
#: Items of one index (its table of bounds has terms x blocks entries).
INDEX_ITEMS = 2_000
#: Indexes searched in one pass over the documents take this much at most (or are one).
BROADCAST_BYTES = 256 << 20
_PUNCTUATION = bytes.maketrans(_MARKS := b".,;:!?\"'()[]{}", b" " * len(_MARKS))


def normal_words(text: bytes | None) -> list[bytes]:
    """Words in lower case without punctuation."""
    return (text or b"").lower().translate(_PUNCTUATION).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """Words of all sentences but the last, and of the last; of one sentence,
    its words and none.  A last sentence under four words joins the question."""
    parts = [p for p in re.split(r"(?<=[.!?])\s+", text.strip()) if p]
    words = [normal_words(p.encode()) for p in parts]
    if len(words) > 1 and len(words[-1]) >= 4:
        return [w for p in words[:-1] for w in p], words[-1]
    return [w for p in words for w in p], []


def grams(words: list[bytes], n: int = 3) -> set[tuple[bytes, ...]]:
    n = min(n, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


class _Terms(dict):
    """Numbers of terms, -1 for others."""

    def __missing__(self, term: bytes) -> int:
        return -1


def entries_of(words: list[bytes]) -> list[list[bytes]]:
    """The index entries of an item."""
    return [words[at : at + MAX_ENTRY] for at in range(0, len(words), MAX_ENTRY)]


class Statistics:
    """Of all entries of all items: their number, mean and largest length, and how
    many hold a term."""

    def __init__(self, n: int, words: int, longest: int, df: dict[bytes, int]) -> None:
        self.n, self.mean, self.longest, self.df = n, words / max(1, n), max(1, longest), df

    @classmethod
    def of(cls, entries: list[list[bytes]]) -> Statistics:
        return cls(len(entries), sum(map(len, entries)), max(map(len, entries), default=0), Counter(t for e in entries for t in set(e)))


class BlockMaxIndex:
    """Postings (entry, weight) by term and block of ``block`` entries, with the
    largest weight of each term in each block.  ``known``: the statistics of all
    entries, of which these may be a part."""

    def __init__(self, entries: list[list[bytes]], known: Statistics | None = None, k1: float = 1.2, b: float = 0.75, block: int = 4) -> None:
        self.n, self.block, self.blocks = len(entries), block, -(-len(entries) // block)
        known = known or Statistics.of(entries)
        counts, df, mean = [Counter(e) for e in entries], known.df, known.mean
        own = {t for c in counts for t in c}
        self.term = _Terms((t, i) for i, t in enumerate(sorted(own)))
        self.lists: list[dict[int, tuple[list[int], list[float]]]] = [{} for _ in self.term]
        self.most = np.zeros((len(self.term), self.blocks), np.float32)
        for d, c in enumerate(counts):
            weight = {}
            for t, tf in c.items():
                idf = math.log(1 + (known.n - df[t] + 0.5) / (df[t] + 0.5))
                weight[t] = idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(entries[d]) / max(mean, 1e-9)))
            total = sum(weight.values())
            for t, w in weight.items():
                docs, weights = self.lists[self.term[t]].setdefault(d // block, ([], []))
                docs.append(d)
                weights.append(w / total)
                self.most[self.term[t], d // block] = max(self.most[self.term[t], d // block], w / total)

    def partition(self, share: float) -> tuple[np.ndarray, np.ndarray]:
        """The terms that passages are first looked up by, as a mask, and the
        most that the others give any entry of each block.  The most frequent
        terms are set aside while that stays below ``share``."""
        aside, sums = np.zeros(len(self.term), bool), np.zeros(max(1, self.n))
        common = sorted(range(len(self.term)), key=lambda t: (-sum(len(d) for d, _ in self.lists[t].values()), t))
        for t in common[:200]:
            more = sums.copy()
            for docs, weights in self.lists[t].values():
                more[docs] += weights
            if more.max() < share:
                sums, aside[t] = more, True
        most = np.zeros(max(1, self.blocks))
        np.maximum.at(most, np.arange(self.n) // self.block, sums[: self.n])
        return ~aside, most

    def search(self, terms: list[int], theta: float, blocks: np.ndarray | None = None) -> list[tuple[int, float]]:
        """All entries whose weight over the distinct ``terms`` reaches ``theta``:
        blocks whose largest weights fall short are skipped (``blocks``: those
        left by earlier bounds), in the others the pivot moves as in WAND."""
        theta -= 1e-6
        terms = list(dict.fromkeys(terms))
        if blocks is None:
            blocks = np.arange(self.blocks)
        bound = self.most[terms][:, blocks].sum(axis=0, dtype=np.float64) if terms else np.zeros(len(blocks))
        found = []
        for block in blocks[bound >= theta]:
            cursors = []
            for t in terms:
                own = self.lists[t].get(int(block))
                if own:
                    cursors.append([own[0][0], 0, own[0], own[1], max(own[1])])
            while cursors:
                cursors.sort(key=_position)
                reach, pivot = 0.0, None
                for c in cursors:
                    reach += c[4]
                    if reach >= theta:
                        pivot = c[0]
                        break
                if pivot is None:
                    break
                if cursors[0][0] == pivot:
                    weight = sum(c[3][c[1]] for c in cursors if c[0] == pivot)
                    if weight >= theta:
                        found.append((pivot, weight))
                    pivot += 1
                left = []
                for c in cursors:
                    while c[1] < len(c[2]) and c[2][c[1]] < pivot:
                        c[1] += 1
                    if c[1] < len(c[2]):
                        c[0] = c[2][c[1]]
                        left.append(c)
                cursors = left
        return found


def _position(cursor: list) -> int:
    return cursor[0]


class Matcher:
    """The index with what verification and the first pass need."""

    def __init__(self, items: list[tuple[int | None, str]], theta: float, overlap: float, known: Statistics | None = None) -> None:
        self.theta, self.overlap = theta, overlap
        self.ids = [i for i, _ in items]
        self.parts = [[(min(3, len(p)), grams(p)) for p in question_and_answer(t) if p] for _, t in items]
        entries, self.owner, self.place = [], [], []
        self.spans = []
        for k, (_, text) in enumerate(items):
            own = entries_of(normal_words(text.encode()))
            entries += own
            self.owner += [k] * len(own)
            self.place += range(len(own))
            self.spans.append(len(own))
        known = known or Statistics.of(entries)
        self.stride = known.longest
        self.index = BlockMaxIndex(entries, known)
        self.needed, self.aside = self.index.partition(theta / 2)

    def size(self) -> int:
        """About so many bytes are broadcast."""
        return self.index.most.nbytes + 200 * sum(len(d) for t in self.index.lists for d, _ in t.values()) + 200 * sum(len(g) for p in self.parts for _, g in p)

    def passages(self, ids: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(text, passage, blocks) that can reach ``theta``, for texts whose index
        terms are ``ids`` (-1: not indexed).  A passage's bound in a block is the
        sum of its distinct needed terms' largest weights there, plus what the
        terms set aside give at most."""
        s = self.stride
        cells = -(-lengths // s)
        first_cell = np.cumsum(cells) - cells
        at = np.flatnonzero(ids >= 0)
        at = at[self.needed[ids[at]]]
        text = np.repeat(np.arange(len(lengths)), lengths)[at]
        inside = at - (np.cumsum(lengths) - lengths)[text]
        cell = first_cell[text] + inside // s
        earlier = np.flatnonzero(inside >= s)
        width = len(self.index.term) + 1
        keys = np.unique(np.concatenate([cell * width + ids[at], (cell[earlier] - 1) * width + ids[at[earlier]]]))
        passage, term = keys // width, keys % width
        starts = np.append(np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]])), len(keys)) if len(keys) else np.zeros(1, int)
        for a in range(0, len(starts) - 1, 1024):
            cut = starts[a : a + 1025]
            bounds = np.add.reduceat(self.index.most[term[cut[0] : cut[-1]]], cut[:-1] - cut[0], axis=0) + self.aside
            reach = bounds >= self.theta - 1e-5
            for r in np.flatnonzero(reach.any(axis=1)):
                p = passage[cut[r]]
                t = int(np.searchsorted(first_cell, p, "right")) - 1
                yield t, int(p - first_cell[t]), np.flatnonzero(reach[r])

    def matches(self, texts: list[list[bytes]]) -> list[dict[int, tuple[float, float]]]:
        """For each text: item position -> (weight share, overlap) of the best passage."""
        lengths = np.array([len(t) for t in texts], np.int64)
        ids = np.fromiter(map(self.index.term.__getitem__, chain.from_iterable(texts)), np.int32, int(lengths.sum()))
        begins = np.cumsum(lengths) - lengths
        best: list[dict[int, tuple[float, float]]] = [{} for _ in texts]
        if not self.index.n or not len(ids):
            return best
        for t, p, blocks in self.passages(ids, lengths):
            a, b = p * self.stride, min((p + 2) * self.stride, int(lengths[t]))
            span = ids[begins[t] + a : begins[t] + b]
            hits = self.index.search(np.unique(span[span >= 0]).tolist(), self.theta, blocks)
            for entry, weight in hits:
                k, words = self.owner[entry], texts[t][a:b]
                if self.spans[k] > 1:  # the item begins about so many words before its entry
                    begin = max(0, a - (self.place[entry] + 1) * self.stride)
                    words = texts[t][begin : a + (self.spans[k] - self.place[entry] + 2) * self.stride]
                share = self._overlap(k, words)
                if share >= self.overlap:
                    old = best[t].get(k, (0.0, 0.0))
                    best[t][k] = (max(old[0], weight), max(old[1], share))
        return best

    def _overlap(self, item: int, words: list[bytes]) -> float:
        """The smaller of the shares of question and answer grams in ``words``,
        whose grams are as long as those of the part."""
        parts = self.parts[item]
        text = {n: grams(words, n) for n in {n for n, _ in parts}}
        return min((len(g & text[n]) / len(g) for n, g in parts), default=0.0)


def statistics(items: DataFrame) -> DataFrame:
    """term, df of the entries of ``items`` (item_id, t); the rows with a null
    term hold the number of entries, their words and the longest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df: Counter = Counter()
        n = words = longest = 0
        for b in slices(batches, "t"):
            for text in as_bytes(b.column("t")):
                for e in entries_of(normal_words(text)):
                    df.update(set(e))
                    n, words, longest = n + 1, words + len(e), max(longest, len(e))
            if len(df) > 200_000:
                yield pa.RecordBatch.from_arrays([pa.array(df.keys(), pa.binary()), pa.array(df.values(), pa.int64()), *[pa.nulls(len(df), pa.int64())] * 2], ["term", "df", "words", "longest"])
                df.clear()
        yield pa.RecordBatch.from_arrays([pa.array([*df, None], pa.binary()), pa.array([*df.values(), n], pa.int64()), *[pa.array([None] * len(df) + [x], pa.int64()) for x in (words, longest)]], ["term", "df", "words", "longest"])

    found = items.mapInArrow(run, "term binary, df long, words long, longest long")
    return found.groupBy("term").agg(F.sum("df").alias("df"), F.sum("words").alias("words"), F.max("longest").alias("longest"))


def matchers(items: DataFrame, theta: float, overlap: float) -> Iterator[Matcher]:
    """Matchers over all items, one at a time; the driver holds one."""
    usable = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("t")).where("t is not null")
    order = lambda x: (x[0] is None, x[0] or 0, x[1])
    parts = max(1, math.ceil(usable.count() / INDEX_ITEMS))
    if parts == 1:
        yield Matcher(sorted(((r[0], r[1]) for r in usable.collect()), key=order), theta, overlap)
        return
    known = scratch.table(statistics(usable), "terms")
    total = known.where("term is null").first()
    for part in range(parts):
        some = usable.where(F.pmod(F.xxhash64("item_id", "t"), F.lit(parts)) == part)
        own = known.join(statistics(some).select("term"), "term")  # the terms of this part only
        df = {bytes(r["term"]): r["df"] for r in own.select("term", "df").collect()}
        rows = sorted(((r[0], r[1]) for r in some.collect()), key=order)  # about INDEX_ITEMS
        yield Matcher(rows, theta, overlap, Statistics(total["df"], total["words"], total["longest"], df))


def _portions(spark: SparkSession, found: Iterator[Matcher]) -> Iterator[Broadcast]:
    held, size = [], 0
    for m in found:
        if held and size + m.size() > BROADCAST_BYTES:
            yield spark.sparkContext.broadcast(held)
            held, size = [], 0
        held.append(m)
        size += m.size()
    yield spark.sparkContext.broadcast(held)


def contaminated(docs: DataFrame, items: DataFrame, theta: float = 0.5, overlap: float = 0.5, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document and item it contains: the columns ``keep``, item_id,
    score (share of the item's BM25 weight) and overlap."""
    (text,) = free([*keep], "text_read")
    rows = docs.select(*keep, F.col("text").alias(text))
    out = None
    for shared in _portions(docs.sparkSession, matchers(items, theta, overlap)):
        found = _scan(rows, text, shared, keep)
        out = found if out is None else out.union(found)
    return out


def _scan(rows: DataFrame, text: str, shared: Broadcast, keep: tuple[str, ...]) -> DataFrame:
    schema = rows.select(*keep).withColumns({"item_id": F.lit(None).cast("long"), "score": F.lit(0.0), "overlap": F.lit(0.0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text, 2 << 20):
            words = [normal_words(t) for t in as_bytes(b.column(text))]
            at, ids, scores, overlaps = [], [], [], []
            for matcher in shared.value:
                for i, found in enumerate(matcher.matches(words)):
                    for k, (score, share) in sorted(found.items()):
                        at.append(i)
                        ids.append(matcher.ids[k])
                        scores.append(score)
                        overlaps.append(share)
            part = b.take(pa.array(at, pa.int64()))
            arrays = [part.column(c) for c in keep] + [pa.array(ids, pa.int64()), pa.array(scores, pa.float64()), pa.array(overlaps, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return rows.mapInArrow(run, schema)


def without_items(docs: DataFrame, items: DataFrame, theta: float = 0.5, overlap: float = 0.5) -> DataFrame:
    """The rows of ``docs``, whole, that contain no item; rows are neither joined
    nor shuffled."""
    for shared in _portions(docs.sparkSession, matchers(items, theta, overlap)):
        docs = _clean(docs, shared)
    return docs


def _clean(docs: DataFrame, shared: Broadcast) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 2 << 20):
            words = [normal_words(t) for t in as_bytes(b.column("text"))]
            fine = np.ones(len(words), bool)
            for matcher in shared.value:
                fine &= [not found for found in matcher.matches(words)]
            yield b.filter(pa.array(fine))

    return docs.mapInArrow(run, docs.schema)
