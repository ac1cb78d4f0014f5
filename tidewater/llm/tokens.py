"""Words and their hashes, by the batch.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z lower-cased:
what ``bytes.lower`` and ``bytes.split`` do on UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import SparkSession

U64 = np.uint64
_MIX_A, _MIX_B = U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53)
_STEP = U64(0x9E3779B97F4A7C15)
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


class _Cache(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


class WordHasher:
    """64-bit hashes of words; remembers at most about ``limit`` of them."""

    def __init__(self, limit: int = 400_000) -> None:
        self._cache, self._limit = _Cache(), limit

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self._cache) > self._limit:
            self._cache.clear()
        return np.fromiter(map(self._cache.__getitem__, words), U64, len(words))


def words_of(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, null as None."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> U64(33))
    x = x * _MIX_A
    x ^= x >> U64(33)
    x *= _MIX_B
    x ^= x >> U64(33)
    return x


def shingle_set(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles; with fewer words
    the whole sequence counts as one shingle, without words there is none."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(n, width)
    rolled = np.full(n - size + 1, size, U64)
    for k in range(size):
        rolled = rolled * _STEP + hashes[k : n - size + 1 + k]
        rolled ^= rolled >> U64(29)
    return np.unique(mix(rolled))


def flat(texts: Iterable[bytes | None], hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of all texts, and how many each text has."""
    words: list[bytes] = []
    lengths = []
    for text in texts:
        own = words_of(text)
        lengths.append(len(own))
        words += own
    return hasher(words), np.array(lengths, np.int64)


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` of each holds about ``max_bytes`` at most
    (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = batch.column(column)
        lengths = pa.compute.fill_null(pa.compute.binary_length(sizes), 0).to_numpy(zero_copy_only=False)
        ends, start, total = np.cumsum(lengths), 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, total + max_bytes, "right")))
            yield batch.slice(start, stop - start)
            total, start = int(ends[stop - 1]), stop


def small_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """From now on Spark hands rows to Python in batches of about ``most`` bytes
    (one row at least), whole groups excepted; a lower setting stays.  Spark's own
    bound is 64 MB, which each task holds outside the heap, twice while a buffer
    grows, and its worker once more.  The session keeps the setting, as plans take
    it when they run."""
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH))
    if not 0 < size <= most:
        spark.conf.set(_BATCH, f"{most}b")
