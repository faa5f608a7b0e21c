"""An encoder that is fitted to the texts: inverse document frequencies and a randomised range finder.

A text is a sparse vector of hashed words, each ``(1 + ln tf) * ln((n + 1) / (df + 1))``, of length 1. The dense space is spanned by what a
few passes of subspace iteration find of the texts' matrix: a random basis is multiplied by the matrix and its transpose, and
made orthonormal again. Words that keep the same company so get close, and frequent words say little.

Each pass is one distributed sum: a task adds up its texts' share of (buckets x dimensions) numbers, shares are added per block of
buckets by tasks, and the driver gets one matrix, whose size doesn't depend on the texts. The fitted encoder has that size too (4 MB
by default) and is what ``reviews.encoded_vectors`` takes: a function from a list of texts to their vectors.

Defined cases: a null or empty text, and one without any known word, has the zero vector. Texts may repeat; each counts. Without texts, or
with fewer dimensions in them than asked for, the space is filled up with random directions.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What the tasks run travels to them as it is here, so that executors needn't have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
FITTED_MODEL = "fitted-1"
#: Blocks of buckets in which the tasks' shares are added up.
BLOCKS = 32


@dataclass(frozen=True)
class Encoder:
    """``encoder(texts)`` gives one vector of length 1 (or 0) per text."""

    weights: np.ndarray  # of a bucket, from its document frequency
    basis: np.ndarray  # buckets x dimensions, orthonormal columns

    def sparse(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Buckets and values of a text."""
        size = len(self.weights)
        n = Counter(zlib.crc32(w.lower().encode("utf-8", "surrogatepass")) % size for w in _WORD.findall(text or ""))
        at = np.fromiter(n, np.int64, len(n))
        values = (1.0 + np.log(np.fromiter(n.values(), np.float64, len(n)))) * self.weights[at]
        length = np.linalg.norm(values)
        return at, values / length if length else values

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros((len(texts), self.basis.shape[1]))
        for i, text in enumerate(texts):
            at, values = self.sparse(text)
            out[i] = values @ self.basis[at]
        lengths = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(lengths == 0, 1.0, lengths)


def _frequencies(texts: DataFrame, buckets: int) -> tuple[int, np.ndarray]:
    """Number of texts, and of those that have a word in each bucket."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = 0, np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = {zlib.crc32(w.lower().encode("utf-8", "surrogatepass")) % buckets for w in _WORD.findall(text or "")}
                df[list(words)] += 1
                n += 1
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(df[used], n))], names=["bucket", "n"])

    summed = texts.mapInArrow(each, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = {r.bucket: r.n for r in summed.toLocalIterator()}  # at most one row per bucket
    df = np.zeros(buckets)
    for bucket, n in found.items():
        if bucket >= 0:
            df[bucket] = n
    return found.get(-1, 0), df


def _multiplied(texts: DataFrame, encoder: Encoder) -> np.ndarray:
    """A'A times the basis, for the matrix A of the texts' sparse vectors."""
    buckets, width = encoder.basis.shape
    rows = -(-buckets // BLOCKS)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, used = np.zeros((buckets, width)), False
        for batch in batches:
            for text in batch.column(0).to_pylist():
                at, values = encoder.sparse(text)
                total[at] += values[:, None] * (values @ encoder.basis[at])
                used = True
        if used:
            parts = [total[i * rows : (i + 1) * rows].tobytes() for i in range(BLOCKS)]
            yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int32()), pa.array(parts, pa.binary())], names=["block", "part"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                sums[i] = sums.get(i, 0.0) + np.frombuffer(part.as_py())
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["block", "part"])

    schema = "block int, part binary"
    out = np.zeros((buckets, width))
    for r in texts.mapInArrow(partial, schema).repartition(BLOCKS, "block").mapInArrow(added, schema).toLocalIterator():
        share = np.frombuffer(bytes(r.part)).reshape(-1, width)
        out[r.block * rows : r.block * rows + len(share)] = share
    return out


def fit(texts: DataFrame, column: str = "comment", buckets: int = 1 << 13, dimensions: int = 64, passes: int = 3, seed: int = 4) -> Encoder:
    """Fit an encoder to all texts; each pass and the counting before them read them once."""
    texts = texts.select(F.col(f"`{column}`").cast("string").alias("text"))
    n, df = _frequencies(texts, buckets)
    weights = np.where(df > 0, np.log((n + 1.0) / (df + 1.0)), 0.0)
    noise = np.random.default_rng(seed).normal(size=(buckets, dimensions))
    basis = np.linalg.qr(noise)[0]
    for _ in range(passes if n else 0):
        found = _multiplied(texts, Encoder(weights, basis))
        # What the texts don't span is filled up with a little of the random directions.
        basis = np.linalg.qr(found + 1e-9 * max(np.abs(found).max(), 1e-9) * noise)[0]
    return Encoder(weights, basis)
