"""Quality: a factorisation machine over hashed words, structure and metadata.

    y(x) = w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

The pairwise part is half the difference of the squared sum and the sum of
squares of ``v_i x_i``, so a text costs time linear in its distinct words.
Features: hashed words (weights log(1 + count), scaled to length 1), numbers
that describe the structure of the text, and buckets of given metadata columns.

Training takes a bounded sample: ``rows`` documents, whole, however long.  The
driver gets their features, at most 2**bits numbers of a document.  A fifth of
the sample turns raw scores into probabilities.

Nulls: a null text counts as empty; a null metadata value has a bucket of its
own; a null id is scored and never trained on.  Empty texts have structure and
metadata only.  Repeated rows, and ties, get equal scores.  Without usable labels
all scores are 0.5.  Empty tables give an empty result.  Names of ``keep`` may
clash with nothing but ``names``, the names of the two columns that are added.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labelled import platt, sigmoid, training_sample
from .tokens import U64, WordHasher, as_bytes, mix, slices, words_of

STRUCTURE = ("words", "word_bytes", "symbols", "letters", "digits", "lines", "line_words", "distinct", "longest", "upper", "bars", "ends", "repeats")
_KINDS = np.zeros((256, 5), np.float32)
for _b in range(256):
    _c = bytes([_b])
    _KINDS[_b] = (_c.isalpha() or _b >= 128, _c.isdigit(), _c.isupper(), _b in b".!?", not (_c.isalnum() or _c.isspace() or _b >= 128 or _b in b".,;:!?'\"()-"))


def structure(text: bytes, words: list[bytes], distinct: int, repeats: float) -> list[float]:
    """Numbers that describe a text, each about 0 to 1."""
    n, size = len(words), max(1, len(text))
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256) if text else np.zeros(256)
    letter, digit, upper, end, symbol = (counts @ _KINDS) / size
    lines = text.count(b"\n") + 1
    return [
        np.log1p(n) / 10,
        min(2.0, (size - counts[32]) / max(1, n) / 10),
        min(1.0, symbol * 5),
        letter,
        digit,
        np.log1p(lines) / 8,
        np.log1p(n / lines) / 6,
        distinct / max(1, n),
        min(2.0, np.log1p(max(map(len, words), default=0)) / 4),
        min(1.0, upper * 5),
        min(1.0, counts[124] / max(1, n) * 3),
        min(1.0, end / max(1, n) * size * 3),
        repeats,
    ]


class FactorisationMachine:
    """Features 0..len(STRUCTURE)-1 are the structure, the next ``meta`` the
    metadata buckets, the rest hashed words."""

    def __init__(self, bits: int = 17, rank: int = 6, meta: int = 256, seed: int = 9) -> None:
        self.base = len(STRUCTURE) + meta
        self.bits, self.meta = bits, meta
        n = self.base + (1 << bits)
        self.w0, self.w = 0.0, np.zeros(n, np.float32)
        self.v = np.random.default_rng(seed).normal(0, 0.05, (n, rank)).astype(np.float32)
        self.slope, self.shift, self.trained = 1.0, 0.0, False

    def features(self, texts: list[bytes | None], meta: list[list[object]], hasher: WordHasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, values, rows' lengths) of a batch."""
        ids, values, lengths = [], [], []
        for text, own in zip(texts, meta):
            text = text or b""
            words = words_of(text)
            hashed = (mix(hasher(words)) & U64((1 << self.bits) - 1)).astype(np.int64)
            uniq, count = np.unique(hashed, return_counts=True)
            value = np.log1p(count)
            value /= max(1e-9, np.sqrt((value**2).sum()))
            bucket = [len(STRUCTURE) + self.bucket(k, x) for k, x in enumerate(own)]
            ids += [np.arange(len(STRUCTURE)), np.array(bucket, np.int64), uniq + self.base]
            values += [np.array(structure(text, words, len(uniq), float((hashed[1:] == hashed[:-1]).mean()) if len(hashed) > 1 else 0.0)), np.full(len(bucket), 0.3), value]
            lengths.append(len(STRUCTURE) + len(bucket) + len(uniq))
        join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
        return join(ids, np.int32), join(values, np.float32), np.array(lengths, np.int64)

    def bucket(self, column: int, value: object) -> int:
        if isinstance(value, (int, float)) and not isinstance(value, bool) and value == value and abs(value) < 1e300:
            value = int(np.sign(value) * np.log2(1 + abs(value)) * 2)
        return int(mix(np.array([hash_text(f"{column}:{value!r}")], U64))[0] % U64(self.meta))

    def raw(self, ids: np.ndarray, values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        if not len(lengths):
            return np.zeros(0)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        vx = self.v[ids] * values[:, None]
        total = np.add.reduceat(vx, starts, axis=0)
        squares = np.add.reduceat((vx**2).sum(axis=1), starts)
        linear = np.add.reduceat(self.w[ids] * values, starts)
        return self.w0 + linear + 0.5 * ((total**2).sum(axis=1) - squares)

    def score(self, ids, values, lengths) -> np.ndarray:
        if not self.trained:
            return np.full(len(lengths), 0.5)
        return sigmoid(self.slope * self.raw(ids, values, lengths).astype(np.float64) + self.shift)

    def fit(self, ids, values, lengths, label, epochs: int = 10, rate: float = 0.1, decay: float = 1e-4, seed: int = 2) -> None:
        """Adagrad on the logistic loss, classes weighed alike."""
        starts = np.concatenate([[0], np.cumsum(lengths)])
        gw, gv, g0 = np.full_like(self.w, 1e-2), np.full_like(self.v, 1e-2), 1e-2
        part = label.mean()
        weight = np.where(label > 0, 0.5 / max(part, 1e-6), 0.5 / max(1 - part, 1e-6)) ** 0.5
        rng = np.random.default_rng(seed)
        for _ in range(epochs):
            order = rng.permutation(len(label))
            for at in range(0, len(order), 32):
                batch = order[at : at + 32]
                take = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in batch])
                i, x, n = ids[take], values[take], lengths[batch]
                row = np.repeat(np.arange(len(batch)), n)
                v = self.v[i]
                total = np.add.reduceat(v * x[:, None], np.concatenate([[0], np.cumsum(n)[:-1]]), axis=0)
                error = ((sigmoid(self.raw(i, x, n)) - label[batch]) * weight[batch] / len(batch)).astype(np.float32)
                e = error[row] * x
                dv = e[:, None] * (total[row] - v * x[:, None])
                uniq, inv = np.unique(i, return_inverse=True)
                dw = np.bincount(inv, e, len(uniq)) + decay * self.w[uniq]
                dvu = np.stack([np.bincount(inv, dv[:, k], len(uniq)) for k in range(v.shape[1])], axis=1) + decay * self.v[uniq]
                gw[uniq] += dw**2
                gv[uniq] += dvu**2
                self.w[uniq] -= rate * dw / np.sqrt(gw[uniq])
                self.v[uniq] -= rate * 0.5 * dvu / np.sqrt(gv[uniq])
                g0 += float(error.sum()) ** 2
                self.w0 -= rate * float(error.sum()) / np.sqrt(g0)
        self.trained = True


def hash_text(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text)


def train(sample: DataFrame, meta_cols: list[str], **shape) -> FactorisationMachine:
    """``sample``: doc_id, text, label and ``meta_cols``; bounded by the caller."""
    model = FactorisationMachine(**shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for b in slices(batches, "text"):
            meta = list(zip(*[b.column(c).to_pylist() for c in meta_cols])) or [[]] * b.num_rows
            ids, values, lengths = model.features(as_bytes(b.column("text")), meta, hasher)
            ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (ids, values)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"), *lists], ["doc_id", "label", "ids", "xs"])

    got = sample.select("doc_id", "label", "text", *meta_cols).mapInArrow(run, "doc_id long, label int, ids array<int>, xs array<float>").toArrow()
    label = got["label"].to_numpy().astype(np.float64)
    if len(label) < 20 or len(set(label)) < 2:
        return model
    ids, xs = got["ids"].combine_chunks(), got["xs"].combine_chunks()
    order = np.argsort(got["doc_id"].to_numpy(), kind="stable")

    def of(rows):
        picked = [ids[int(i)].values.to_numpy() for i in rows], [xs[int(i)].values.to_numpy() for i in rows]
        return np.concatenate(picked[0]), np.concatenate(picked[1]), np.array([len(x) for x in picked[0]])

    held = np.arange(len(order)) % 5 == 4
    model.fit(*of(order[~held]), label[order[~held]])
    model.slope, model.shift = platt(model.raw(*of(order[held])).astype(np.float64), label[order[held]])
    return model


def score_texts(docs: DataFrame, model: FactorisationMachine, keep: list[str], meta_cols: list[str], text_col: str = "text", name: str = "score") -> DataFrame:
    """``keep`` columns of ``docs`` plus the score as ``name``, over whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few MB, whatever the input
    # columns are read under numbers, so names never clash; a kept column is not sent twice
    inputs = list(dict.fromkeys([*keep, *meta_cols, text_col]))
    at = {c: f"c{k}" for k, c in enumerate(inputs)}
    rows = docs.select(*[F.col(f"`{c}`").alias(at[c]) for c in inputs])
    text = at[text_col]
    out = rows.select(*[at[c] for c in keep]).withColumn("s", F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, hasher = shared.value, WordHasher()
        for b in slices(batches, text, 4 << 20):
            meta = list(zip(*[b.column(at[c]).to_pylist() for c in meta_cols])) or [[]] * b.num_rows
            score = model.score(*model.features(as_bytes(b.column(text)), meta, hasher))
            yield pa.RecordBatch.from_arrays([b.column(at[c]) for c in keep] + [pa.array(score, pa.float64())], out.names)

    return rows.mapInArrow(run, out).toDF(*keep, name)


def quality(docs: DataFrame, labels: DataFrame, learn_from: Column, rows: int = 6000, threshold: float = 0.3, meta_cols: tuple[str, ...] = ("n_chars",), keep: tuple[str, ...] = ("doc_id",), names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """The columns ``keep``, the score (probability of label 1) and whether it
    reaches ``threshold`` (1 or 0), under ``names``."""
    meta = [c for c in meta_cols if c in docs.columns]
    model = train(training_sample(docs, labels, "quality", learn_from, rows, meta), meta)
    scored = score_texts(docs, model, list(keep), meta, name=names[0])
    return scored.withColumn(names[1], (F.col(names[0]) >= threshold).cast("int"))
