"""Toxicity: a convolutional text classifier trained in numpy.

A word's embedding is the sum of those of its parts (the whole word and some
prefixes, so that unseen inflections are known by their stems).  A part takes
one row from each of two hashed tables, side by side, so that two parts share
an embedding only if they collide in both.
Filters of several widths slide over the embedded words of the whole text; the
largest response of each filter (max pooling) feeds a logistic unit.  Parts
seen in fewer than ``min_docs`` training documents have no embedding (zero),
so unknown words are neutral however long the text is.

Training takes every labelled document, whole, however long.  They are dealt by
a hash of the id into shares of about ``rows`` documents.  In each round all
shares go once through their documents, side by side, from one common model;
then each parameter moves by the mean of its moves in the shares that moved it,
and so does the sum of squares that sets its step.  A single share is plain
Adagrad.  Moves are summed in fixed point, so their order and the number of
workers do not matter.  The driver gets the model of a round, whatever the
input; no text and no word comes to it.

A fifth of every share is held out from the rounds, to turn scores into
probabilities and to calibrate one threshold for each language on all of them
(the driver gets score, label and language of each); the language chooses a
threshold, and never changes a score.

Nulls: a null or empty text gets the score of no words.  A null language takes
the common threshold.  A null id is scored and never trained on.  Documents that
have no label are scored alike.  Repeated rows, and ties, get equal scores.
Without usable labels all scores are 0.  Empty tables give an empty result.
Columns other than doc_id, text and lang are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from copy import deepcopy

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import scratch
from .labelled import all_labelled, best_threshold, platt, sigmoid
from .tokens import U64, as_bytes, mix, slices, words_of

_EDGE = b".,;:!?\"'()[]{}<>*_-%$&#|"
#: Besides the whole word, prefixes of so many bytes are embedded.
PREFIXES = (4, 5, 6, 7)


def word_parts(words: list[bytes]) -> np.ndarray:
    """(n, 1 + prefixes) hashes of the parts of words; 0 where a word is too short."""
    out = np.zeros((len(words), 1 + len(PREFIXES)), U64)
    h = xxhash.xxh64_intdigest
    for i, w in enumerate(words):
        if w:
            out[i, 0] = h(w)
            for k, n in enumerate(PREFIXES, 1):
                if len(w) < n:
                    break
                out[i, k] = h(w[:n], n)
    return out


class _Index(dict):
    """Numbers of clean words, by words as they stand in a text, so that each
    spelling is cleaned once."""

    def __init__(self) -> None:
        self.new: list[bytes] = []
        self._clean: dict[bytes, int] = {}

    def __missing__(self, word: bytes) -> int:
        clean = word.strip(_EDGE)
        value = self._clean.get(clean)
        if value is None:
            value = self._clean[clean] = len(self._clean)
            self.new.append(clean)
        self[word] = value
        return value


class TextCNN:
    def __init__(self, bits: int = 17, dim: int = 8, widths=(1, 2, 3), filters: int = 12, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self.bits, self.dim, self.widths, self.filters = bits, dim, tuple(widths), filters
        self.tables = [rng.normal(0, 0.05, ((1 << bits) + 1, dim)).astype(np.float32) for _ in range(2)]
        for t in self.tables:
            t[-1] = 0  # the row of parts that do not exist
        self.kernels = [rng.normal(0, 1 / np.sqrt(2 * dim * k), (2 * dim * k, filters)).astype(np.float32) for k in self.widths]
        self.biases = [np.zeros(filters, np.float32) for _ in self.widths]
        self.out = rng.normal(0, 0.1, filters * len(self.widths)).astype(np.float32)
        self.out_bias, self.slope, self.shift = 0.0, 1.0, 0.0
        self.thresholds: dict[str | None, float] = {None: 0.3}
        self.trained = False

    def rows_of(self, parts: np.ndarray) -> np.ndarray:
        """(2, n, parts) table rows of hashed parts."""
        mask = U64((1 << self.bits) - 1)
        rows = np.stack([parts & mask, mix(parts) & mask]).astype(np.int32)
        rows[:, parts == 0] = 1 << self.bits
        return rows

    def embed(self, rows: np.ndarray) -> np.ndarray:
        """(n, 2 * dim): a word is the sum of its parts."""
        out = np.concatenate([self.tables[i].take(rows[i][:, 0], axis=0) for i in range(2)], axis=1)
        for i in range(2):
            own = out[:, i * self.dim : (i + 1) * self.dim]
            for k in range(1, rows.shape[2]):
                own += self.tables[i].take(rows[i][:, k], axis=0)  # much faster than an index
        return out

    def _windows(self, x: np.ndarray, k: int) -> np.ndarray:
        n = len(x) - k + 1
        return np.concatenate([x[i : i + n] for i in range(k)], axis=1)

    @staticmethod
    def _cut(h: np.ndarray, ends: np.ndarray, k: int) -> None:
        """No window reaches from one text's padding into the next text."""
        for i in range(1, k):
            h[ends - i] = -np.inf

    def pooled(self, vectors: np.ndarray, pieces: list[np.ndarray], owner: list[int], n: int) -> np.ndarray:
        """Max-pooled responses of ``n`` texts.  ``pieces`` hold rows of
        ``vectors`` (whose last row is zero); a long text may have several
        pieces that overlap by the largest width - 1."""
        pad = np.full(max(self.widths), len(vectors) - 1)
        x = vectors.take(np.concatenate([x for p in pieces for x in (p, pad)]), axis=0)
        ends = np.cumsum([len(p) + len(pad) for p in pieces])
        starts = np.concatenate([[0], ends[:-1]])
        out = np.zeros((n, self.filters * len(self.widths)), np.float32)
        for j, k in enumerate(self.widths):
            h = self._windows(x, k) @ self.kernels[j]
            self._cut(h, ends[:-1], k)
            part = np.maximum(np.maximum.reduceat(h, starts, axis=0) + self.biases[j], 0)
            np.maximum.at(out[:, j * self.filters : (j + 1) * self.filters], owner, part)
        return out

    def raw(self, vectors: np.ndarray, texts: list[np.ndarray], piece: int = 1 << 15, group: int = 1 << 16) -> np.ndarray:
        """Raw scores of texts given as rows of ``vectors``, whatever their lengths."""
        over, out = max(self.widths) - 1, np.zeros((len(texts), self.filters * len(self.widths)), np.float32)
        todo = [(i, t[a : a + piece + over]) for i, t in enumerate(texts) for a in range(0, max(1, len(t) - over), piece)]
        at = 0
        while at < len(todo):
            stop, size = at, 0
            while stop < len(todo) and (stop == at or size < group):
                size += len(todo[stop][1])
                stop += 1
            owner = [i for i, _ in todo[at:stop]]
            low, high = owner[0], owner[-1] + 1
            part = self.pooled(vectors, [p for _, p in todo[at:stop]], [i - low for i in owner], high - low)
            np.maximum(out[low:high], part, out=out[low:high])
            at = stop
        return out @ self.out + self.out_bias

    def score(self, vectors: np.ndarray, texts: list[np.ndarray]) -> np.ndarray:
        if not self.trained:
            return np.zeros(len(texts))
        # float32 products differ in their last bits with the shape of a batch
        return sigmoid(np.round(self.slope * self.raw(vectors, texts).astype(np.float64) + self.shift, 3))

    # -- training
    def _strongest(self, vectors: np.ndarray, ids: np.ndarray, ends: np.ndarray, piece: int = 1 << 15) -> tuple[np.ndarray, list[np.ndarray]]:
        """Each text's largest response of each filter, and for each width where in
        ``ids`` these begin.  Texts end at ``ends``, padding included; the responses
        of a long one are computed piece by piece."""
        f, over = self.filters, max(self.widths) - 1
        best, where = np.full((len(ends), f * len(self.widths)), -np.inf, np.float32), [np.zeros((len(ends), f), np.int64) for _ in self.widths]
        starts = np.concatenate([[0], ends[:-1]])
        todo = [(t, a, min(a + piece + over, e)) for t, (s, e) in enumerate(zip(starts, ends)) for a in range(s, max(s + 1, e - over), piece)]
        at = 0
        while at < len(todo):
            stop, size = at, 0
            while stop < len(todo) and (stop == at or size < piece):
                size += todo[stop][2] - todo[stop][1]
                stop += 1
            x = vectors.take(np.concatenate([ids[a:b] for _, a, b in todo[at:stop]]), axis=0)
            for j, k in enumerate(self.widths):
                h = self._windows(x, k) @ self.kernels[j] + self.biases[j]
                begin = 0
                for t, a, b in todo[at:stop]:
                    own = h[begin : begin + b - a - k + 1]  # no window reaches into the next text
                    arg = own.argmax(axis=0)
                    value, old = own[arg, np.arange(f)], best[t, j * f : (j + 1) * f]
                    where[j][t] = np.where(value > old, arg + a, where[j][t])
                    np.maximum(old, value, out=old)
                    begin += b - a
            at = stop
        return best, where

    def start(self, known: np.ndarray) -> None:
        """Begin training; parts that are not ``known`` (2, table rows) have no embedding."""
        for t, own in zip(self.tables, known):
            t[~own] = 0
        self.squares = [np.full_like(x, 1e-3) for x in (*self.tables, *self._dense())]
        self.bias_square = 1e-3

    def _dense(self) -> list[np.ndarray]:
        return [*self.kernels, *self.biases, self.out]

    def state(self) -> np.ndarray:
        """Rows of ``dim`` parameters and their ``dim`` sums of squares: first
        those of the tables, then all others."""
        sides = []
        for arrays, last in ((self.tables + self._dense(), self.out_bias), (self.squares, self.bias_square)):
            rest = np.concatenate([x.ravel() for x in arrays[2:]] + [[last]])
            sides.append(np.concatenate([*[t[:-1] for t in arrays[:2]], np.pad(rest, (0, -len(rest) % self.dim)).reshape(-1, self.dim)]))
        return np.concatenate(sides, axis=1, dtype=np.float32)

    def restore(self, state: np.ndarray) -> None:
        lasts, n = [], 1 << self.bits
        for side, arrays in enumerate((self.tables + self._dense(), self.squares)):
            own = state[:, side * self.dim : (side + 1) * self.dim]
            arrays[0][:-1], arrays[1][:-1] = own[:n], own[n : 2 * n]
            rest, at = own[2 * n :].ravel(), 0
            for x in arrays[2:]:
                x[...] = rest[at : at + x.size].reshape(x.shape)
                at += x.size
            lasts.append(float(rest[at]))
        self.out_bias, self.bias_square = lasts

    def fit(self, rows: np.ndarray, texts: list[np.ndarray], label: np.ndarray, known: np.ndarray, weight: float, round_: int, rate: float = 0.1, seed: int = 3) -> None:
        """One round of Adagrad on the logistic loss, after ``start``; a step touches
        only the words that gave some filter its largest response.  ``texts`` hold
        numbers of words, ``rows`` the table rows of these, ``weight`` is that of label 1."""
        weight = np.where(label > 0, weight, 1.0)
        dense, squares, table_squares = self._dense(), self.squares[2:], self.squares[:2]
        rng, f, w = np.random.default_rng([seed, round_]), self.filters, len(self.widths)
        order, met, number = rng.permutation(len(texts)), np.zeros(rows.shape[1], bool), np.zeros(rows.shape[1], np.int64)
        for at in range(0, len(order), 32):
            batch = order[at : at + 32]
            words = np.concatenate([texts[i] for i in batch])
            met[words] = True
            used = np.flatnonzero(met)
            met[used], number[used] = False, np.arange(len(used))
            inverse = number.take(words)
            vectors = np.concatenate([self.embed(rows.take(used, axis=1)), np.zeros((1, 2 * self.dim), np.float32)])
            cuts = np.cumsum([len(texts[i]) for i in batch])[:-1]
            pad = np.full(max(self.widths), len(used))
            ids = np.concatenate([y for p in np.split(inverse, cuts) for y in (p, pad)])
            best, where = self._strongest(vectors, ids, np.cumsum([len(texts[i]) + len(pad) for i in batch]))
            act = np.maximum(best, 0)
            error = ((sigmoid(act @ self.out + self.out_bias) - label[batch]) * weight[batch] / len(batch)).astype(np.float32)
            back = np.outer(error, self.out) * (best > 0)
            grads: list = [None] * len(dense)
            grads[-1] = act.T @ error + 1e-5 * self.out
            down_all = np.zeros_like(vectors)
            for j, k in enumerate(self.widths):
                g, arg = back[:, j * f : (j + 1) * f], where[j]
                windows = np.concatenate([vectors[ids[arg + i]] for i in range(k)], axis=2)
                grads[j] = np.einsum("bfd,bf->df", windows, g)
                grads[w + j] = g.sum(axis=0)
                down = np.einsum("bf,df->bfd", g, self.kernels[j]).reshape(len(batch), f, k, -1)
                for i in range(k):
                    np.add.at(down_all, ids[arg + i].ravel(), down[:, :, i].reshape(-1, 2 * self.dim))
            down_all[-1] = 0
            hit = np.flatnonzero((down_all != 0).any(axis=1))
            for i in range(2):
                row = rows[i][used[hit]]
                grad = np.repeat(down_all[hit, None, i * self.dim : (i + 1) * self.dim], row.shape[1], axis=1)
                keep = known[i][row]
                uniq, inv = np.unique(row[keep], return_inverse=True)
                total = np.zeros((len(uniq), self.dim), np.float32)
                np.add.at(total, inv, grad[keep])
                table_squares[i][uniq] += total**2
                self.tables[i][uniq] -= rate * total / np.sqrt(table_squares[i][uniq])
            for p, (value, grad) in enumerate(zip(dense, grads)):
                squares[p] += grad**2
                value -= rate * grad / np.sqrt(squares[p])
            self.bias_square += float(error.sum()) ** 2
            self.out_bias -= rate * float(error.sum()) / np.sqrt(self.bias_square)


#: A move of 1 in fixed point, and how many rows of a state are summed together.
_ONE, _BLOCK = float(1 << 24), 1 << 13
_UNIT_WORDS = 1 << 24
_UNITS = (
    "docs int, pos int, fit_docs int, fit_pos int, label array<int>, lang array<string>, lengths array<int>, "
    "n_words int, words binary, rows binary, slots array<int>, slot_docs array<int>"
)


def _packed(x: np.ndarray) -> bytes:
    """Numbers by planes of their bytes, compressed."""
    x = np.ascontiguousarray(x)
    return pa.compress(x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes(), "zstd", asbytes=True) if x.size else b""


def _unpacked(data: bytes, kind: type, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(data, n * size, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(kind).ravel()


def _units(rows: DataFrame, shares: int, most: int, model: TextCNN) -> DataFrame:
    """The documents of ``rows`` as numbers of words, in rows of the shared folder
    that are trained on as one: a share, or a part of it if that is very long."""
    share = F.pmod(F.xxhash64("doc_id"), F.lit(shares)).cast("int")
    rows = rows.select("doc_id", "label", "lang", "text", share.alias("share")).repartitionById(shares, F.col("share"))
    rows = rows.sortWithinPartitions("share", "doc_id", F.xxhash64("text"), "lang").select("share", "label", "lang", "text")

    def unit(index: _Index, held: list[bool], label: list[int], lang: list, texts: list[np.ndarray]) -> pa.RecordBatch:
        table, slots = model.rows_of(word_parts(index.new)), 2 << model.bits
        seen = np.zeros(slots, np.int32)
        for text in (t for t, out in zip(texts, held) if not out):
            own = table[:, np.unique(text)]
            for i in range(2):
                found = np.unique(own[i])
                seen[found[found < 1 << model.bits] + (i << model.bits)] += 1
        hit = np.flatnonzero(seen)
        fit = [y for y, out in zip(label, held) if not out]
        # held documents are marked by a label of 2 or 3 instead of 0 or 1
        row = [len(label), sum(label), len(fit), sum(fit), [y + 2 * out for y, out in zip(label, held)], lang, [len(t) for t in texts], len(index.new)]
        row += [_packed(np.concatenate(texts)), _packed(table), hit.astype(np.int32), seen[hit]]
        kinds = [pa.int32()] * 4 + [pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.int32()), pa.int32(), pa.binary(), pa.binary()] + [pa.list_(pa.int32())] * 2
        names = [c.split()[0] for c in _UNITS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at, words = None, 0, 0
        index, held, label, lang, texts = _Index(), [], [], [], []
        for b in slices(batches, "text"):
            for own, y, language, text in zip(b.column("share").to_pylist(), b.column("label").to_pylist(), b.column("lang").to_pylist(), as_bytes(b.column("text"))):
                if texts and (own != now or len(texts) >= 2 * most or words >= _UNIT_WORDS):
                    yield unit(index, held, label, lang, texts)
                    index, held, label, lang, texts, words = _Index(), [], [], [], [], 0
                at, now = at + 1 if own == now else 0, own
                found = words_of(text)
                texts.append(np.fromiter(map(index.__getitem__, found), np.int32, len(found)))
                held.append(at % 5 == 4)
                label.append(y)
                lang.append(language)
                words += len(found)
        if texts:
            yield unit(index, held, label, lang, texts)

    return scratch.table(rows.mapInArrow(run, _UNITS), "toxicity")


def _opened(b: pa.RecordBatch, bits: int) -> Iterator[tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray, list]]:
    """Table rows, texts, labels, whether held out, and languages of each unit."""
    for k in range(b.num_rows):
        row = {c: b.column(c)[k] for c in ("label", "lengths", "n_words", "words", "rows", "lang")}
        label, lengths = row["label"].values.to_numpy(), row["lengths"].values.to_numpy().astype(np.int64)
        words = _unpacked(row["words"].as_py(), np.int32, int(lengths.sum()))
        n = row["n_words"].as_py()
        rows = _unpacked(row["rows"].as_py(), np.int32, 2 * n * (1 + len(PREFIXES))).reshape(2, n, -1 if n else 1 + len(PREFIXES))
        yield rows, np.split(words, np.cumsum(lengths)[:-1]), (label & 1).astype(np.float64), label >= 2, row["lang"].as_py()


def _round(units: DataFrame, model: TextCNN, known: np.ndarray, weight: float, round_: int) -> None:
    """All units go once through their documents; ``model`` moves by the mean of their moves."""
    sc = units.sparkSession.sparkContext
    base = model.state()
    shared = sc.broadcast((model, known))  # as large whatever the input
    width = base.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, known = shared.value
        base, total = first.state(), None
        for b in batches:
            for rows, texts, label, held, _ in _opened(b, first.bits):
                fit = np.flatnonzero(~held)
                if not len(fit):
                    continue
                own = deepcopy(first)
                own.fit(rows, [texts[i] for i in fit], label[fit], known, weight, round_)
                state = own.state()
                moved = (state != base).any(axis=1)
                moved[2 << first.bits :] = True
                moved = np.flatnonzero(moved)
                total = np.zeros((len(base), width + 1), np.int64) if total is None else total
                total[moved, :-1] += np.rint((state[moved] - base[moved]) * np.float32(_ONE)).astype(np.int64) * len(fit)
                total[moved, -1] += len(fit)
        if total is not None:
            for at in range(0, len(total), _BLOCK):
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([_packed(total[at : at + _BLOCK])], pa.binary())], ["block", "moves"])

    def add(key: tuple, group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = key[0].as_py()
        n = (min(at + _BLOCK, rows_) - at) * (width + 1)
        total = np.zeros(n, np.int64)
        for b in group:
            for data in b.column("moves"):
                total += _unpacked(data.as_py(), np.int64, n)
        total = total.reshape(-1, width + 1)
        mean = (total[:, :-1] / (np.maximum(total[:, -1:], 1) * _ONE)).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([mean.tobytes()], pa.binary())], ["block", "moves"])

    rows_, schema = len(base), "block int, moves binary"
    # a worker sends one sum, however many units it has
    moves = units.coalesce(max(1, sc.defaultParallelism)).mapInArrow(run, schema)
    for row in moves.groupBy("block").applyInArrow(add, schema).collect():
        mean = np.frombuffer(bytes(row["moves"]), np.float32).reshape(-1, width)
        base[row["block"] : row["block"] + len(mean)] += mean
    model.restore(base)
    shared.destroy()


def _held_scores(units: DataFrame, model: TextCNN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Raw score, label and language of all held-out documents, in an order of their own."""
    shared = units.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            for rows, texts, label, held, lang in _opened(b, model.bits):
                vectors = np.concatenate([model.embed(rows), np.zeros((1, 2 * model.dim), np.float32)])
                out = np.flatnonzero(held)
                raw = model.raw(vectors, [texts[i] for i in out])
                arrays = [pa.array(raw, pa.float32()), pa.array(label[out], pa.float64()), pa.array([lang[i] for i in out], pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, ["raw", "label", "lang"])

    got = units.mapInArrow(run, "raw float, label double, lang string").toArrow()
    shared.destroy()
    raw, label = got["raw"].to_numpy().astype(np.float64), got["label"].to_numpy()
    lang = np.array(got["lang"].to_pylist(), object)
    order = np.lexsort([np.array([x or "" for x in lang], str), label, raw])
    return raw[order], label[order], lang[order]


def train(labelled: DataFrame, n: int, rows: int = 5000, epochs: int = 8, min_docs: int = 3, **shape) -> TextCNN:
    """``labelled``: doc_id, text, label, lang, all of them are learned from; about
    ``n`` rows, in shares of about ``rows``."""
    model = TextCNN(**shape)
    units = _units(labelled, max(1, -(-n // rows)), rows, model)
    found = units.agg(*[F.sum(c).alias(c) for c in ("docs", "pos", "fit_docs", "fit_pos")]).first()
    if (found["docs"] or 0) < 20 or found["pos"] in (0, found["docs"]):
        return model
    slots = units.select(F.explode(F.arrays_zip("slots", "slot_docs")).alias("x")).groupBy("x.slots").agg(F.sum("x.slot_docs").alias("docs"))
    often = slots.where(F.col("docs") >= min_docs).toArrow()["slots"].to_numpy()
    known = np.zeros((2, (1 << model.bits) + 1), bool)
    known[often >> model.bits, often & ((1 << model.bits) - 1)] = True
    model.start(known)
    weight = float(np.sqrt(max(1.0, (found["fit_docs"] - found["fit_pos"]) / max(1, found["fit_pos"]))))
    for k in range(epochs):
        _round(units, model, known, weight, k)
    del model.squares
    model.trained = True
    raw, label, langs = _held_scores(units, model)
    model.slope, model.shift = platt(raw, label)
    score = sigmoid(model.slope * raw + model.shift)
    model.thresholds[None] = best_threshold(score, label)
    for lang in sorted({x for x in langs if x is not None}):
        own = langs == lang
        model.thresholds[lang] = best_threshold(score[own], label[own], model.thresholds[None])
    return model


class Embedder:
    """Rows of words in a matrix of embeddings that grows with the words met,
    up to about ``limit`` of them."""

    def __init__(self, model: TextCNN, limit: int = 300_000) -> None:
        self.model, self.limit = model, limit
        self._reset()

    def _reset(self) -> None:
        self.index, self.size = _Index(), 0
        self.matrix = np.zeros((1 << 14, 2 * self.model.dim), np.float32)

    def __call__(self, texts: list[bytes | None]) -> tuple[np.ndarray, list[np.ndarray]]:
        if self.size > self.limit:
            self._reset()
        get = self.index.__getitem__
        rows = []
        for text in texts:
            words = words_of(text)
            rows.append(np.fromiter(map(get, words), np.int64, len(words)))
        new, self.index.new = self.index.new, []
        total = self.size + len(new)
        if total + 1 > len(self.matrix):
            self.matrix = np.concatenate([self.matrix[: self.size], np.zeros((total + (1 << 14), self.matrix.shape[1]), np.float32)])
        for at in range(0, len(new), 1 << 14):
            some = new[at : at + (1 << 14)]
            self.matrix[self.size + at : self.size + at + len(some)] = self.model.embed(self.model.rows_of(word_parts(some)))
        self.size = total
        self.matrix[total] = 0
        return self.matrix[: total + 1], rows


def score_texts(docs: DataFrame, model: TextCNN, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns of ``docs`` plus ``score``, over whole texts."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # a few MB, whatever the input
    rows = docs.select(*keep, F.col(text_col).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        embedder = Embedder(model)
        for b in slices(batches, "__text", 4 << 20):
            score = model.score(*embedder(as_bytes(b.column("__text"))))
            arrays = [b.column(c) for c in keep] + [pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, [*keep, "score"])

    return rows.mapInArrow(run, rows.select(*keep).withColumn("score", F.lit(0.0)).schema)


def toxicity(docs: DataFrame, labels: DataFrame, learn_from: Column, rows: int = 5000, threshold: float = 0.3) -> DataFrame:
    """doc_id, score, predicted (score >= ``threshold``), and predicted_by_lang
    (by the threshold calibrated for the document's language).  All labelled
    documents that pass ``learn_from`` are learned from, in shares of about ``rows``."""
    if "lang" not in docs.columns:
        docs = docs.withColumn("lang", F.lit(None).cast("string"))
    model = train(*all_labelled(docs, labels, "toxic", learn_from, ["lang"]), rows)
    scored = score_texts(docs, model, ["doc_id", "lang"])
    by_lang = F.lit(float(model.thresholds[None]))
    for lang, cut in model.thresholds.items():
        if lang is not None:
            by_lang = F.when(F.col("lang") == lang, F.lit(float(cut))).otherwise(by_lang)
    return scored.select(
        "doc_id",
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        (F.col("score") >= by_lang).cast("int").alias("predicted_by_lang"),
    )
