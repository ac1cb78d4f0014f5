"""Near-duplicate documents: a multi-index Hamming join over b-bit MinHash.

A document is the set of its distinct five-word shingles.  Its signature has
``slots`` MinHash values of 16 bits each; the signature distance of two
documents is the number of slots that differ.  The signature is split into
chunks of four slots.  If two signatures differ in at most ``2 * chunks - 1``
slots then, by the pigeonhole principle, some chunk has at most one error; so
each document is listed under every chunk with each one of its slots left out
(four keys a chunk), and all pairs within that distance share a key.
``plan_chunks`` picks so many chunks that a pair exactly at the similarity
threshold exceeds the distance with a probability below 1e-5.

Keys held by several documents link them as follows; no key's documents are
ever gathered or all paired with one another.

1. Documents with equal sets are one node, whatever their ids.
2. Each node is compared with the first node of the keys it shares most often
   (one comparison a node), on full shingle sets.
3. Where a key still holds several components, the nodes outside its largest one
   (strangers) are compared with all others of the key by signature, block by
   block, and what neither the distance nor set sizes nor long signatures refute
   is compared on full sets: first each stranger's nearest node of the largest
   component and of all others only, which joins most of what belongs together;
   then all that are still apart.
   The work on a key is its strangers times its nodes, so linear where nearly
   all belong together; blocks have bounded size, so a key with any number of
   nodes is spread over tasks.

Nulls: a row with a null id is never linked; its component is null and it is
kept.  Null and empty texts, and texts without words, have the empty set and
are linked with nothing.  With fewer than five words the whole sequence is one
shingle.  Rows that repeat an id and text share their component; rows that
repeat an id with other texts are documents of their own, each with the
smallest id among the rows it is linked with.  Only doc_id and text are looked
at, whatever other columns there are.  Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch
from .components import components
from .tokens import U64, WordHasher, as_bytes, mix, shingle_set, slices, words_of

CHUNK = 4
#: Slots of the signatures that refute pairs under crowded keys (8 bits each).
WIDE = 512
#: Ids up to this number are broadcast to pick their texts (8 bytes each).
BROADCAST_IDS = 1_000_000


def plan_chunks(similarity: float, miss: float = 1e-5) -> int:
    """The fewest chunks for which the guaranteed distance is exceeded at this
    similarity with a probability below ``miss``."""
    for chunks in range(2, 64):
        n, most = CHUNK * chunks, 2 * chunks - 1
        p = 1 - similarity
        if sum(comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(most + 1, n + 1)) < miss:
            return chunks
    raise ValueError(f"no plan for similarity {similarity}")


def allowed(slots: int, similarity: float, miss: float = 1e-6) -> int:
    """So many of ``slots`` may differ that a pair at this similarity exceeds it
    with a probability below ``miss``."""
    p, rest = 1 - similarity, 1.0
    for most in range(slots + 1):
        rest -= comb(slots, most) * p**most * (1 - p) ** (slots - most)
        if rest < miss:
            return most
    return slots


def _constants(slots: int) -> tuple[np.ndarray, np.ndarray]:
    seed = np.arange(1, slots + 1, dtype=U64)
    return mix(seed * U64(0x9E3779B97F4A7C15)), mix(seed * U64(0xD1B54A32D192ED03)) | U64(1)


def signature(shingles: np.ndarray, flips: np.ndarray, factors: np.ndarray, piece: int = 4096) -> np.ndarray:
    """16 low bits of the MinHash of each slot; ``shingles`` is not empty."""
    least = np.full(len(flips), np.iinfo(np.uint64).max, U64)
    for at in range(0, len(shingles), piece):
        part = shingles[None, at : at + piece] ^ flips[:, None]
        part *= factors[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return (least & U64(0xFFFF)).astype(np.uint16)


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """(rows, 4 * chunks) keys of (rows, slots) signatures: every chunk with one
    of its slots left out."""
    rows, slots = signatures.shape
    wide = signatures.astype(U64)
    out = np.empty((rows, slots), U64)
    for slot in range(slots):
        rest = [s for s in range(slot // CHUNK * CHUNK, slot // CHUNK * CHUNK + CHUNK) if s != slot]
        key = (wide[:, rest[0]] << U64(32)) | (wide[:, rest[1]] << U64(16)) | wide[:, rest[2]]
        out[:, slot] = mix(key ^ mix(np.array([slot + 1], U64) * U64(0x9E3779B97F4A7C15)))
    return out


def sketch(docs: DataFrame, chunks: int, width: int = 5) -> DataFrame:
    """Per row: doc_id, text_hash, n_shingles, digest (of the whole set), sig;
    whole texts."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").alias("text"))
    flips, factors = _constants(CHUNK * chunks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for b in slices(batches, "text"):
            sizes, digests, sigs = [], [], []
            for text in as_bytes(b.column("text")):
                found = shingle_set(hasher(words_of(text)), width)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                sigs.append(signature(found, flips, factors).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary())],
                ["doc_id", "text_hash", "n_shingles", "digest", "sig"],
            )

    return rows.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, digest binary, sig binary")


def nodes(sketched: DataFrame) -> DataFrame:
    """One row for each distinct set: id (a number, ascending with doc_id),
    digest, sig, and doc_id and text_hash of the row that stands for it (the
    smallest id)."""
    usable = sketched.where("digest is not null and doc_id is not null")
    found = usable.groupBy("digest").agg(F.min(F.struct("doc_id", "text_hash")).alias("at"), F.first("sig").alias("sig"))
    found = scratch.table(found.select("digest", "sig", "at.*"), "sets")
    n = int(sketched.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = found.repartitionByRange(n, "doc_id", "text_hash").sortWithinPartitions("doc_id", "text_hash")
    return scratch.table(dealt.withColumn("id", F.monotonically_increasing_id()), "nodes")


def first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The first slot left out by a key that the rows of ``a`` and ``b`` share;
    the number of slots where they share none."""
    same = (a == b).reshape(len(a), -1, CHUNK)
    shares = same.sum(axis=2) >= CHUNK - 1
    chunk = shares.argmax(axis=1)
    # all four equal: the first slot; else the one that differs
    slot = np.argmin(same[np.arange(len(a)), chunk], axis=1)
    return np.where(shares.any(axis=1), chunk * CHUNK + slot, a.shape[1])


def _listed(reps: DataFrame, slots: int) -> DataFrame:
    """key, id, slot: each representative under all its keys; ``slot`` is the one
    that a key leaves out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in (b.slice(k, 2000) for k in range(0, b.num_rows, 2000)):
                sigs = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint16).reshape(-1, slots)
                keys = chunk_keys(sigs)
                ids = np.repeat(part.column("id").to_numpy(), slots)
                left_out = np.tile(np.arange(slots, dtype=np.int32), len(sigs))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(ids), pa.array(left_out)], ["key", "id", "slot"])

    return reps.select("id", "sig").mapInArrow(run, "key long, id long, slot int")


def _within(pairs: DataFrame, reps: DataFrame, slots: int, most: int) -> DataFrame:
    """The pairs (a, b) whose signatures differ in at most ``most`` slots."""
    sig_a = reps.select(F.col("id").alias("a"), F.col("sig").alias("sa"))
    sig_b = reps.select(F.col("id").alias("b"), F.col("sig").alias("sb"))
    joined = pairs.join(sig_b, "b").join(sig_a, "a").select("a", "b", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint16).reshape(-1, slots) for c in ("sa", "sb"))
                near = np.flatnonzero((x != y).sum(axis=1) <= most)
                part = b.take(pa.array(near))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"])

    return joined.mapInArrow(run, "a long, b long")


def _confirm(pairs: DataFrame, reps: DataFrame, docs: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs whose full shingle sets have 100 * intersection >= percent * union.
    The set of a node is made once, however many pairs it is in."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for b in slices(batches, "t"):
            sets = [shingle_set(hasher(words_of(t)), width).tobytes() for t in as_bytes(b.column("t"))]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(sets, pa.binary())], ["id", "s"])

    sets = scratch.table(_texts(ids, reps, docs).mapInArrow(make, "id long, s binary"), "sets")
    both = (
        pairs.join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
        .join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")
        .select("a", "b", "sa", "sb")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "sa", 4 << 20):
            ok = []
            for x, y in zip(b.column("sa").to_pylist(), b.column("sb").to_pylist()):
                x, y = np.frombuffer(x, U64), np.frombuffer(y, U64)
                joint = np.concatenate([x, y])
                joint.sort(kind="stable")  # two sorted runs
                shared = int((joint[1:] == joint[:-1]).sum())
                ok.append(len(joint) > 0 and 100 * shared >= percent * (len(joint) - shared))
            part = b.filter(pa.array(ok, pa.bool_()))
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def _wide(ids: DataFrame, reps: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """id, wide, size: long signatures of the nodes ``ids`` and their set sizes."""
    flips, factors = _constants(WIDE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for b in slices(batches, "t"):
            sets = [shingle_set(hasher(words_of(t)), width) for t in as_bytes(b.column("t"))]
            sigs = [signature(x, flips, factors, 512).astype(np.uint8).tobytes() for x in sets]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(sigs, pa.binary()), pa.array([len(x) for x in sets], pa.int64())], ["id", "wide", "size"])

    return _texts(ids, reps, docs).mapInArrow(run, "id long, wide binary, size long")


def _texts(ids: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """id, t of the nodes ``ids`` (one column, distinct).  A node's text is that
    of the row with its doc_id and the hash of its text, once however often that
    row is repeated."""
    wanted = scratch.table(reps.join(ids, "id").select("id", "doc_id", "text_hash"), "wanted")
    few = wanted.count() <= BROADCAST_IDS
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").alias("t"))
    return texts.join(F.broadcast(wanted) if few else wanted, ["doc_id", "text_hash"]).select("id", "t").dropDuplicates(["id"])


def _mixed(placed: DataFrame) -> DataFrame:
    """key, main, n, s of the keys that hold several components: their largest
    one, their nodes, and the strangers among them."""
    parts = placed.groupBy("key", "comp").agg(F.count("*").alias("own"))
    found = parts.groupBy("key").agg(F.max(F.struct("own", "comp")).alias("most"), F.sum("own").alias("n"))
    return found.where("most.own < n").select("key", F.col("most.comp").alias("main"), "n", (F.col("n") - F.col("most.own")).alias("s"))


class _Members:
    """The rows of a group of ``_crossing``, and which pairs of them may be links."""

    def __init__(self, table: pa.Table, slots: int, most: int, percent: int) -> None:
        self.most, self.percent, self.far_wide = most, percent, allowed(WIDE, percent / 100)
        self.asks, self.key, self.slot, self.id, self.comp, self.main, self.size = (table.column(c).to_numpy() for c in ("asks", "key", "slot", "id", "comp", "main", "size"))
        self.sigs = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint16).reshape(-1, slots)
        self.wide = np.frombuffer(b"".join(table.column("wide").to_pylist()), np.uint8).reshape(-1, WIDE)

    def under_one_key(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Strangers against members of a key, all within the distance."""
        by_size = np.argsort(self.size, kind="stable")
        left, right = by_size[self.asks[by_size]], by_size[~self.asks[by_size]]
        sizes = self.size[right]
        for k in range(0, len(left), 128):
            rows = left[k : k + 128]
            # sets of like sizes only: 100 * smaller >= percent * larger
            low = np.searchsorted(sizes, -(-self.size[rows[0]] * self.percent // 100))
            others = right[low : np.searchsorted(sizes, self.size[rows[-1]] * 100 // self.percent, "right")]
            far = np.zeros((len(rows), len(others)), np.uint8)
            for s in range(self.sigs.shape[1]):
                far += self.sigs[rows, s][:, None] != self.sigs[others, s][None, :]
            x, y = np.nonzero(far <= self.most)
            x, y = rows[x], others[y]
            once = (self.comp[y] == self.main[y]) | (self.id[x] < self.id[y])  # two strangers meet twice
            yield x[once], y[once]

    def under_many_keys(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs under each of many keys with few members each."""
        order = np.argsort(self.key, kind="stable")
        for apart in range(1, len(order)):
            same = np.flatnonzero(self.key[order[apart:]] == self.key[order[:-apart]])
            if not len(same):
                return
            x, y = order[same], order[same + apart]
            swap = self.comp[x] == self.main[x]  # the stranger comes first
            yield np.where(swap, y, x), np.where(swap, x, y)

    def pairs(self, found: Iterator[tuple[np.ndarray, np.ndarray]], nearest: bool) -> pa.Table:
        """a, b, apart, main of the pairs that nothing refutes."""
        parts = []
        for x, y in found:
            fits = (self.comp[x] != self.comp[y]) & (100 * np.minimum(self.size[x], self.size[y]) >= self.percent * np.maximum(self.size[x], self.size[y]))
            x, y = x[fits], y[fits]
            for m in range(0, len(x), 4096):
                u, v = x[m : m + 4096], y[m : m + 4096]
                first = first_shared(self.sigs[u], self.sigs[v]) == self.slot[u]
                u, v = u[first], v[first]
                near = (self.sigs[u] != self.sigs[v]).sum(axis=1) <= self.most
                u, v = u[near], v[near]
                apart = (self.wide[u] != self.wide[v]).sum(axis=1)
                near = apart <= self.far_wide
                u, v, apart = u[near], v[near], apart[near]
                main = self.comp[v] == self.main[v]
                if nearest and len(u):
                    order = np.lexsort((self.id[v], apart, main, u))
                    u, v, apart, main = u[order], v[order], apart[order], main[order]
                    least = np.concatenate([[True], (u[1:] != u[:-1]) | (main[1:] != main[:-1])])
                    u, v, apart, main = u[least], v[least], apart[least], main[least]
                parts.append((self.id[u], self.id[v], apart.astype(np.int64), main))
        join = lambda k, kind: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, kind)
        return pa.table({"a": join(0, np.int64), "b": join(1, np.int64), "apart": join(2, np.int64), "main": join(3, bool)})


def _crossing(placed: DataFrame, reps: DataFrame, wide: DataFrame, slots: int, most: int, percent: int, nearest: bool, block: int = 1024, few: int = 64) -> DataFrame:
    """Pairs (a < b) of different components that share a key, lie within the
    distance and are not refuted by set sizes or long signatures.  ``placed``:
    key, slot, id, comp.  A pair is compared under the first key it shares and
    passed over under the others.  ``nearest``: of the pairs of a stranger, the
    nearest one with a main component and the nearest one with any other only.
    Keys with ``few`` nodes at most are gathered, about 5,000 nodes at a time."""
    mixed = scratch.table(_mixed(placed), "mixed")
    dealt = placed.join(mixed, "key").join(reps.select("id", "sig"), "id").join(wide, "id")
    gathered = max(1, -(-(mixed.where(F.col("n") <= few).agg(F.sum("n")).first()[0] or 0) // 5_000))
    members, strangers = F.ceil(F.col("n") / block).cast("int"), F.ceil(F.col("s") / block).cast("int")
    at = lambda blocks: F.pmod(F.xxhash64("id"), blocks).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), blocks - 1))
    columns = ["key", "slot", "id", "comp", "main", "sig", "wide", "size"]
    small, large = dealt.where(F.col("n") <= few), dealt.where(F.col("n") > few)
    small = small.select(*columns, F.lit(False).alias("asks"), F.pmod(F.xxhash64("key"), F.lit(gathered)).alias("cell"), F.lit(-1).alias("i"), F.lit(-1).alias("j"))
    left = large.where("comp != main").select(*columns, F.lit(True).alias("asks"), F.col("key").alias("cell"), every(members).alias("i"), at(strangers).alias("j"))
    right = large.select(*columns, F.lit(False).alias("asks"), F.col("key").alias("cell"), at(members).alias("i"), every(strangers).alias("j"))

    def run(table: pa.Table) -> pa.Table:
        rows = _Members(table, slots, most, percent)
        return rows.pairs(rows.under_many_keys() if table.column("i")[0].as_py() < 0 else rows.under_one_key(), nearest)

    found = small.unionByName(left).unionByName(right).groupBy("cell", "i", "j").applyInArrow(run, "a long, b long, apart long, main boolean")
    if nearest:
        found = found.groupBy("a", "main").agg(F.min_by("b", F.struct("apart", "b")).alias("b"))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    chunks = plan_chunks(percent / 100)
    slots, most = CHUNK * chunks, 2 * chunks - 1
    sketched = scratch.table(sketch(docs, chunks, width), "sketch")
    reps = nodes(sketched)

    listed = _listed(reps, slots)
    shared = listed.groupBy("key").agg(F.min("id").alias("c"), F.max("id").alias("top")).where("c != top")
    members = scratch.table(listed.join(shared.select("key", "c"), "key"), "members")

    stars = members.where("id != c").groupBy("id", "c").agg(F.count("*").alias("k"))
    best = stars.groupBy(F.col("id").alias("b")).agg(F.max_by("c", F.struct("k", -F.col("c"))).alias("a"))
    links = scratch.table(_confirm(scratch.table(_within(best, reps, slots, most), "stars"), reps, docs, percent, width), "confirmed")
    label, wide = components(links), None

    for nearest in (True, False):
        placed = members.join(label, "id", "left").select("key", "slot", "id", F.coalesce("component", "id").alias("comp"))
        placed = scratch.table(placed.join(_mixed(placed).select("key"), "key"), "placed")
        if not placed.limit(1).count():
            break
        if wide is None:
            wide = scratch.table(_wide(placed.select("id").distinct(), reps, docs, width), "wide")
        pairs = scratch.table(_crossing(placed, reps, wide, slots, most, percent, nearest), "crossing")
        more = scratch.table(_confirm(pairs, reps, docs, percent, width), "confirmed")
        if more.limit(1).count():
            links = links.union(more)
            label = components(links)

    # ids ascend with doc_id, so a component's first node has its smallest doc_id
    labelled = scratch.table(label.join(reps.select("id", "digest", "doc_id"), "id"), "labelled")
    smallest = scratch.table(labelled.groupBy("component").agg(F.min("doc_id").alias("__c")), "smallest")
    named = labelled.join(smallest, "component").select("digest", "__c")
    alone = reps.join(label, "id", "left_anti").select("digest", F.col("doc_id").alias("__c"))
    known = F.col("doc_id").isNotNull()
    out = sketched.select("doc_id", "n_shingles", "digest").join(scratch.table(named.union(alone), "named"), "digest", "left")
    component = F.when(known, F.coalesce("__c", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
