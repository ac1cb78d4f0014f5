"""An interpolated modified Kneser-Ney model of any order from 2 on, counted in
Spark, kept as sorted hash arrays in the shared folder and memory-mapped by the
workers.

Each text is ``<start> ... <start> w1 ... wm <end>`` with order - 1 starts;
``<end>`` is a token.  For a gram g of k words, C(g) is its count if k is the
order, else the number of distinct words before it:

    P(w|g) = (max(C(gw) - D, 0) + (D1 N1(g) + D2 N2(g) + D3 N3(g)) P(w|g')) / C(g.)
    P(w)   = max(C(w) - D, 0) / C(.) + (D1 M1 + D2 M2 + D3 M3) / C(.) / (V + 1)

where g' lacks g's first word, Ni(g) is how many words w have C(gw) = i (3: or
more), Mi likewise for words, and C(g.) and C(.) are the sums over w.  The three
discounts of each length come from counts of counts.  A gram that never was a
context leaves P(w|g').

Counting: each task turns about ``chunk`` tokens into distinct grams with counts
and sends them, packed, to shards by the gram's hash; hashes spread evenly, so a
frequent word does not weigh on one shard.  A shard merges its packets, writes
sorted hashes and counts, and sends on what the next shorter grams need to know,
summed up: for the gram without its last word, what follows it; for the gram
without its first, what precedes it.  So it goes down to single words.  The
driver gets one row of totals for each shard of words.

Files are written under temporary names and renamed, so a repeated task does no
harm; they live in the shared folder, so a lost executor takes none along.

Nulls: a null or empty text is ``<end>`` alone; very long texts count and are
scored whole.  A row with a null id counts as a training row.  Repeated rows count
each time, and equal texts get equal scores.  Only doc_id and text are looked at;
``keep`` may name any column but those added.  Without training rows every token
has probability 1 / (V + 1) = 1.  Empty tables give an empty result.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import scratch
from .tokens import U64, WordHasher, as_bytes, flat, mix, slices

START, END = U64(0x243F6A8885A308D3), U64(0x13198A2E03707344)
_K1, _K2 = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F)


def pair_hash(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(v * _K1 + (w ^ (w >> U64(31))) * _K2)


def gram_hash(words: list[np.ndarray]) -> np.ndarray:
    """Of grams given by columns; a single word's is its own."""
    h = words[0]
    for w in words[1:]:
        h = pair_hash(h, w)
    return h


def sequences(h: np.ndarray, lengths: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of texts whose word hashes are ``h``, with starts and ends, and the
    places of the tokens."""
    ends = np.cumsum(lengths)
    begins = np.repeat(ends - lengths, order - 1)
    marks = np.concatenate([begins, ends])
    # at one place a text's end comes before the next one's starts
    rank = np.concatenate([np.repeat(np.arange(len(lengths)) * 2, order - 1), np.arange(len(lengths)) * 2 + 1])
    by = np.argsort(rank, kind="stable")
    values = np.concatenate([np.full(len(begins), START), np.full(len(ends), END)])
    full = np.insert(h, marks[by], values[by])
    first = np.cumsum(lengths + order) - lengths - 1
    tokens = np.repeat(first - np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]), lengths + 1) + np.arange(len(h) + len(lengths))
    return full, tokens.astype(np.int64)


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))


def _small(x: np.ndarray) -> np.ndarray:
    """In the narrowest unsigned type that holds it."""
    return x.astype(np.min_scalar_type(int(x.max())) if len(x) else np.uint8)


def pack(*arrays: np.ndarray) -> bytes:
    out = [np.array([len(arrays)], np.int64).tobytes()]
    for a in arrays:
        out += [np.array([a.dtype.itemsize, len(a)], np.int64).tobytes(), a.tobytes()]
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    at, out = 8, []
    for _ in range(int(np.frombuffer(data, np.int64, 1)[0])):
        width, n = map(int, np.frombuffer(data, np.int64, 2, at))
        out.append(np.frombuffer(data, np.dtype(f"u{width}"), n, at + 16))
        at += 16 + width * n
    return out


def _shards(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)


def pack_grams(words: list[np.ndarray], values: list[np.ndarray]) -> bytes:
    """Grams in the order of their first words: these with their runs, the other
    words, the values."""
    first = runs(words[0])
    return pack(words[0][first], _small(np.diff(np.append(first, len(words[0])))), *words[1:], *[_small(v) for v in values])


def unpack_grams(data: bytes, length: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    arrays = unpack(data)
    return [np.repeat(arrays[0], arrays[1]), *arrays[2 : length + 1]], arrays[length + 1 :]


def count_grams(words: list[np.ndarray], bits: int) -> Iterator[tuple[int, bytes]]:
    """(shard, packed distinct grams with counts)."""
    if not len(words[0]):
        return
    shard = _shards(gram_hash(words), bits)
    order = np.lexsort((*words[::-1], shard))
    words, shard = [w[order] for w in words], shard[order]
    new = np.concatenate([[True], shard[1:] != shard[:-1]])
    for w in words:
        new[1:] |= w[1:] != w[:-1]
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(shard)))
    words, shard = [w[first] for w in words], shard[first]
    cuts = np.append(runs(shard), len(shard))
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(shard[a]), pack_grams([w[a:b] for w in words], [count[a:b]])


def _write(folder: str, name: str, array: np.ndarray) -> None:
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}"
    array.tofile(temporary := f"{path}.{uuid.uuid4().hex}")
    os.replace(temporary, path)


#: What is known of a gram shorter than the order: its sum as a context, the words
#: that follow it once, twice, more often; how often it occurs; the words before it.
TOTAL, ONCE, TWICE, MORE, RAW, OWN = range(6)
FIELDS = 6


def summed(words: list[np.ndarray], values: Iterator[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Hashes of the distinct grams in order, their words, and the sums of each of
    ``values`` over equal grams."""
    h = gram_hash(words)
    order = np.argsort(h)
    h = h[order]
    first = runs(h)
    at = order[first]
    # exact whatever the type: sums of counts stay far below 2**63
    sums = [np.add.reduceat(v[order].astype(np.uint64), first) if len(first) else v.astype(np.uint64) for v in values]
    return h[first], [w[at] for w in words], sums


def merge(packets: list[bytes], length: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    parts = [unpack_grams(p, length) for p in packets]
    words = [np.concatenate([p[0][k] for p in parts]) for k in range(length)]
    return summed(words, (np.concatenate([p[1][k] for p in parts]) for k in range(len(parts[0][1]))))


def shorter(words: list[np.ndarray], count: np.ndarray, raw: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """What grams tell of those one word shorter, summed up: words and FIELDS."""
    nothing = np.zeros(len(count), np.uint8)
    before = [count, count == 1, count == 2, count > 2, nothing, nothing]  # of the gram without its last word
    after = [nothing, nothing, nothing, nothing, raw, np.ones(len(count), np.uint8)]  # without its first
    both = [np.concatenate([a, b]) for a, b in zip(words[:-1], words[1:])]
    _, words, facts = summed(both, (np.concatenate([a.astype(np.uint64), b.astype(np.uint64)]) for a, b in zip(before, after)))
    return words, facts


def packets_of(words: list[np.ndarray], facts: list[np.ndarray], bits: int) -> Iterator[tuple[int, bytes]]:
    """(shard, packed grams with FIELDS)."""
    if not len(words[0]):
        return
    shard = _shards(gram_hash(words), bits)
    order = np.lexsort((words[0], shard))
    words, facts, shard = [w[order] for w in words], [f[order] for f in facts], shard[order]
    cuts = np.append(runs(shard), len(shard))
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(shard[a]), pack_grams([w[a:b] for w in words], [f[a:b] for f in facts])


def discounts(n: np.ndarray) -> list[float]:
    """The three discounts from the numbers of items seen 1, 2, 3 and 4 times."""
    n1, n2, n3, n4 = (float(x) for x in n[:4])
    if not n1 or not n2:
        return [0.5, 0.75, 0.9]  # too few items to tell; some mass must be left for the unseen
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 3 - 4 * y]
    return [min(max(d, 0.05), k) for d, k in zip(raw, (0.99, 1.99, 2.99))]


class Model:
    """Sorted hash arrays in ``folder``; picklable, files are mapped on first use.
    ``counts``: for each length the numbers of grams with counts 1 to 4."""

    def __init__(self, folder: str, order: int, bits: list[int], counts: np.ndarray, tokens: int, words: int, total: int) -> None:
        self.folder, self.order, self.bits = folder, order, bits
        self.tokens, self.words, self.total = tokens, words, total
        self.d = [np.zeros(4)] + [np.array([0.0, *discounts(counts[k])]) for k in range(1, order + 1)]
        d, n = self.d[1], counts[1]
        # words that follow three or more distinct ones are the rest
        self.spread = float(d[1] * n[0] + d[2] * n[1] + d[3] * (words - n[0] - n[1])) / total if total else 1.0

    def _find(self, length: int, hashes: np.ndarray, columns: list[int]) -> np.ndarray:
        """(columns, n) values of grams of a length by sorted hashes, zero where unknown."""
        out, bits = np.zeros((len(columns), len(hashes)), np.int64), self.bits[length]
        cuts = np.searchsorted(hashes >> U64(64 - bits), np.arange((1 << bits) + 1, dtype=U64)) if bits else [0, len(hashes)]
        for shard in range(1 << bits):
            a, b = cuts[shard], cuts[shard + 1]
            if a == b:
                continue
            stem = f"{self.folder}/{length}-{shard}"
            keys = _mapped(f"{stem}.keys", "u8")
            if not len(keys):
                continue
            at = np.minimum(np.searchsorted(keys, hashes[a:b]), len(keys) - 1)
            known = np.flatnonzero(keys[at] == hashes[a:b])
            for i, k in enumerate(columns):
                values = _mapped(f"{stem}.{k}", f"u{os.path.getsize(f'{stem}.{k}') // len(keys)}")
                out[i, a + known] = values[at[known]]
        return out

    def _known(self, length: int, hashes: np.ndarray, columns: list[int]) -> np.ndarray:
        order = np.argsort(hashes)
        out = np.empty((len(columns), len(hashes)), np.int64)
        out[:, order] = self._find(length, hashes[order], columns)
        return out

    def score(self, h: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
        """Per text: tokens, known tokens, base score and model score (log10)."""
        full, tokens = sequences(h, lengths, self.order)
        words, inverse = np.unique(full, return_inverse=True)
        facts = self._find(1, words, [*range(FIELDS)])[:, inverse]
        raw, own = facts[RAW][tokens].astype(np.float64), facts[OWN][tokens]
        d = self.d[1]
        p = np.maximum(own - d[np.minimum(own, 3)], 0) / max(self.total, 1) + self.spread / (self.words + 1)
        grams = full
        for k in range(2, self.order + 1):
            # a gram's hash ends at its last word; the first k - 1 places are of no token
            grams = np.concatenate([grams[:1], pair_hash(grams[:-1], full[1:])]) if k == 2 else self._grams(full, k)
            total, n1, n2, n3 = facts[TOTAL : MORE + 1, tokens - 1].astype(np.float64)  # of the context, which ends a place before
            if k == self.order:
                count = self._known(k, grams[tokens], [0])[0]
            else:
                facts = self._known(k, grams, [*range(FIELDS)])
                count = facts[OWN][tokens]
            d = self.d[k]
            left = d[1] * n1 + d[2] * n2 + d[3] * n3
            high = np.maximum(count - d[np.minimum(count, 3)], 0)
            p = np.where(total > 0, (high + left * p) / np.maximum(total, 1), p)
        base = np.log10((raw + 1) / (self.tokens + (self.words + 1)))
        starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(np.int64)
        add = lambda x: np.add.reduceat(x, starts)
        return lengths + 1, add((raw > 0).astype(np.int64)), add(base), add(np.log10(p))

    @staticmethod
    def _grams(full: np.ndarray, k: int) -> np.ndarray:
        """Hashes of the grams of k words that end at each place (of none at first)."""
        h = gram_hash([full[i : len(full) - k + 1 + i] for i in range(k)])
        return np.concatenate([full[: k - 1], h])


@lru_cache(maxsize=4096)
def _mapped(path: str, dtype: str) -> np.ndarray:
    if not os.path.exists(path) or not os.path.getsize(path):
        return np.zeros(0, np.dtype(dtype))
    return np.memmap(path, np.dtype(dtype), "r")


def _chunks(batches: Iterator[pa.RecordBatch], column: str, chunk: int) -> Iterator[tuple[list[pa.RecordBatch], np.ndarray, np.ndarray]]:
    """Batches gathered until they hold about ``chunk`` tokens, with their word
    hashes and lengths."""
    hasher, held, hs, ns, size = WordHasher(), [], [], [], 0
    for b in slices(batches, column, 4 << 20):
        h, n = flat(as_bytes(b.column(column)), hasher)
        held.append(b)
        hs.append(h)
        ns.append(n)
        size += len(h) + len(n)
        if size >= chunk:
            yield held, np.concatenate(hs), np.concatenate(ns)
            held, hs, ns, size = [], [], [], 0
    if held:
        yield held, np.concatenate(hs), np.concatenate(ns)


def train(docs: DataFrame, order: int = 2, folder: str | None = None, chunk: int = 2_500_000, text_col: str = "text") -> Model:
    """Count all texts of ``docs`` into a model of ``order`` words in ``folder`` (a new
    one in the shared folder; every worker must see it under the same path)."""
    if order < 2:
        raise ValueError("the order is 2 or more")
    spark = docs.sparkSession
    folder = folder or scratch.mappable_dir(spark, "kneser-ney")
    rows = docs.select(F.col(text_col).alias("t"))
    most = int(min(20, max(3, np.ceil(np.log2(max(1, docs.count()) / 8000)) + (order > 2))))
    bits = [0, max(2, most - 2 - (order > 2)), *[most] * (order - 1)]

    def table(found: Iterator[tuple[int, bytes]]) -> pa.Table:
        shards, packets = [], []
        for shard, packet in found:
            shards.append(shard)
            packets.append(packet)
        return pa.table({"shard": pa.array(shards, pa.int32()), "packet": pa.array(packets, pa.binary())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, h, n in _chunks(batches, "t", chunk):
            full, tokens = sequences(h, n, order)
            for shard, packet in count_grams([full[tokens - k] for k in range(order - 1, -1, -1)], bits[order]):
                yield table([(shard, packet)]).to_batches()[0]

    def store(length: int, shard: int, h: np.ndarray, values: list[np.ndarray]) -> np.ndarray:
        for k, v in enumerate(values):
            _write(folder, f"{length}-{shard}.{k}", _small(v))
        _write(folder, f"{length}-{shard}.keys", h)
        own = values[0] if length == order else values[OWN]
        tally = np.zeros((order + 1, 4), np.uint64)
        tally[length] = [(own == k).sum() for k in (1, 2, 3, 4)]
        return tally

    def totals(packets: list[bytes]) -> np.ndarray:
        return np.sum([unpack(p)[0].reshape(order + 1, 4) for p in packets], axis=0, dtype=np.uint64)

    def level(length: int):
        def run(key: tuple[pa.Scalar, ...], found: pa.Table) -> pa.Table:
            shard, packets = key[0].as_py(), found["packet"].to_pylist()
            if shard < 0:
                return table([(-1, pack(totals(packets).ravel()))])
            h, words, values = merge(packets, length)
            tally = store(length, shard, h, values)
            if length < order:
                grams = np.flatnonzero(values[OWN])  # the others are contexts only
                words, values = [w[grams] for w in words], [v[grams] for v in values]
            counts = (values[0], values[0]) if length == order else (values[OWN], values[RAW])
            return table([(-1, pack(tally.ravel())), *packets_of(*shorter(words, *counts), bits[length - 1])])

        return run

    def finish(key: tuple[pa.Scalar, ...], found: pa.Table) -> pa.Table:
        shard, packets = key[0].as_py(), found["packet"].to_pylist()
        if shard < 0:
            row = [totals(packets).ravel().tolist(), 0, 0, 0]
        else:
            h, _, values = merge(packets, 1)
            tally = store(1, shard, h, values)
            row = [tally.ravel().tolist(), int(values[RAW].sum()), int((values[RAW] > 0).sum()), int(values[OWN].sum())]
        return pa.table({"counts": pa.array([row[0]], pa.list_(pa.int64())), "tokens": [row[1]], "words": [row[2]], "total": [row[3]]})

    packets = "shard int, packet binary"
    found = rows.mapInArrow(count, packets)
    for length in range(order, 1, -1):
        found = found.groupBy("shard").applyInArrow(level(length), packets)
    ends = found.groupBy("shard").applyInArrow(finish, "counts array<long>, tokens long, words long, total long").collect()  # a row for each shard of words
    add = lambda name: sum(r[name] for r in ends)
    counts = np.sum([r["counts"] for r in ends], axis=0).reshape(order + 1, 4) if ends else np.zeros((order + 1, 4), int)
    return Model(folder, order, bits, counts, add("tokens"), add("words"), add("total"))


def score(docs: DataFrame, model: Model, keep: list[str], chunk: int = 1_000_000, text_col: str = "text") -> DataFrame:
    """``keep`` columns, n_tokens, n_known, train_tokens, base_score, score and
    perplexity of whole texts."""
    rows = docs.select(*keep, F.col(text_col).alias("__text"))
    new = {"n_tokens": F.lit(0).cast("long"), "n_known": F.lit(0).cast("long"), "train_tokens": F.lit(0).cast("long"), "base_score": F.lit(0.0), "score": F.lit(0.0), "perplexity": F.lit(0.0)}
    schema = rows.select(*keep).withColumns(new).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, h, lengths in _chunks(batches, "__text", chunk):
            tokens, known, base, own = model.score(h, lengths)
            results = [pa.array(x) for x in (tokens, known, np.full(len(tokens), model.tokens), base, own, 10 ** np.minimum(-own / tokens, 300))]
            at = 0
            for b in held:
                part = [x.slice(at, b.num_rows) for x in results]
                at += b.num_rows
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], *part], schema.names)

    return rows.mapInArrow(run, schema)


def perplexity(docs: DataFrame, learn_from: Column, keep: list[str] | None = None, order: int = 2) -> DataFrame:
    """Train on the rows of ``docs`` for which ``learn_from`` holds (null holds),
    and score all of them."""
    model = train(docs.where(F.coalesce(learn_from, F.lit(True))), order)
    return score(docs, model, keep or ["doc_id"])
