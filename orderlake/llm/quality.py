"""Quality classifier: random Fourier features over document statistics, ridge scores, isotonic calibration.

The statistics of a text go through ``sqrt(2/D) cos(Wx + b)``, which approximates a Gaussian kernel. Ridge
weights come from normal equations that every partition sums for itself; a monotone step function, fitted
on binned scores, turns them into probabilities. Text never moves: training shuffles the statistics of
labelled documents only, and scoring is one pass over the documents.

Defined cases: a null text counts as empty and gets a score like any other. Repeated documents and ties get equal
scores; a document that is labelled twice counts twice, a null label not at all. Labels of one kind only
give every document the share of label 1, no labels at all give 0.5. Other input columns are carried through; a
column named like a result column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm.common import written

#: Characters whose share of the text is a statistic of its own.
MARKS = "!?.,;:'\"-_#$%&*@/\\|<>()[]{}=+~^`"
N_STATS = 24 + len(MARKS)


def statistics(text: str) -> np.ndarray:
    """Numbers that describe how a text is written; none depends on its language's words."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n = max(len(raw), 1)
    counts = np.bincount(raw, minlength=256).astype(np.float64)
    share = counts / n
    words, lines = text.split(), [s for s in text.split("\n") if s]
    n_words, n_lines = max(len(words), 1), max(len(lines), 1)
    kinds = set(words)
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    line_lengths = np.fromiter(map(len, lines), np.float64, len(lines)) if lines else np.zeros(1)
    present = share[share > 0]
    last = "".join([w[-1] for w in words])
    first = "".join([w[0] for w in words])
    ends = sum(map(last.count, "#$%&*!"))
    capital = sum(c.isupper() for c in first)
    stops = counts[ord(".")] + counts[ord("!")] + counts[ord("?")]
    head = [
        np.log1p(len(text)),
        np.log1p(len(words)),
        np.log1p(len(lines)),
        share[65:91].sum(),
        share[97:123].sum(),
        share[48:58].sum(),
        share[128:].sum(),
        share[32],
        share[10] * 10,
        share[:32].sum() - share[10],
        -(present * np.log2(present)).sum(),
        share.max(),
        lengths.mean(),
        lengths.std(),
        np.log1p(lengths.max()),
        len(kinds) / n_words,
        len(kinds) / np.sqrt(n_words),
        len(set(lines)) / n_lines,
        np.log1p(line_lengths.mean()),
        np.log1p(line_lengths.std()),
        ends / n_words,
        capital / n_words,
        np.log1p(len(words) / (stops + 1)),
        sum(len(w) < 2 for w in words) / n_words,
    ]
    return np.concatenate([head, np.sqrt([share[ord(c)] for c in MARKS])])


def _all_statistics(column: pa.Array) -> np.ndarray:
    return np.stack([statistics(t or "") for t in column.to_pylist()]) if len(column) else np.zeros((0, N_STATS))


@dataclass
class QualityModel:
    """Bounded in size by the number of random features and calibration steps, whatever the corpus."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray | None
    steps: np.ndarray
    levels: np.ndarray
    prior: float

    def features(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.scale, -6.0, 6.0)
        z = np.sqrt(2.0 / len(self.phases)) * np.cos(x @ self.directions + self.phases)
        return np.hstack([z, x, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        return np.interp(self.raw(x), self.steps, self.levels)


def _map_rows(df: DataFrame, each, schema: T.StructType) -> DataFrame:
    return df.mapInArrow(lambda batches: (b for batch in batches for b in each(batch)), schema)


def with_statistics(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``stats array<double>``."""
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("stats", T.ArrayType(T.DoubleType()))])

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        x = _all_statistics(batch.column(len(keep)))
        offsets = np.arange(len(x) + 1, dtype=np.int32) * N_STATS
        stats = pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], stats], names=[*keep, "stats"])

    return _map_rows(df.select(*keep, text), each, schema)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATS)


def _normal_equations(rows: DataFrame, model: QualityModel, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of z'z and z'y: one partial sum per partition, added up row by row of the matrix."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            z = model.features(_matrix(batch))
            y = batch.column("label").to_numpy(zero_copy_only=False)
            total += z.T @ np.hstack([z, y[:, None]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(size), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], names=["i", "row"]
        )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column("i").to_pylist(), batch.column("row").to_pylist(), strict=True):
                sums[i] = sums.get(i, 0.0) + np.frombuffer(row)
        if sums:
            rows = [pa.array(sums, pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())]
            yield pa.RecordBatch.from_arrays(rows, names=["i", "row"])

    parts = rows.mapInArrow(partial, "i int, row binary").repartition(8, "i")
    total = np.zeros((size, size + 1))
    for i, row in parts.mapInArrow(added, "i int, row binary").collect():
        total[i] += np.frombuffer(bytes(row))
    return total[:, :-1], total[:, -1]


def pool_adjacent(x: np.ndarray, hits: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of hit shares over ascending x: block centres and their non-decreasing levels."""
    blocks: list[list[float]] = []
    for centre, h, k in zip(x, hits, n, strict=True):
        blocks.append([centre * k, h, k])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    label: str = "quality",
    features: int = 256,
    bandwidth: float = 4.0,
    ridge: float = 1e-3,
    bins: int = 400,
    max_rows: int = 150_000,
    seed: int = 5,
) -> QualityModel:
    """Train on the labelled documents; at most about ``max_rows`` of them, picked by a hash of the key."""
    labels = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    labels = labels.select(F.col(key).alias("k"), F.col(label).cast("double").alias("label"))
    total, hits = labels.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).head()
    rng = np.random.default_rng(seed)
    directions = rng.normal(0.0, 1.0 / bandwidth, (N_STATS, features)) / np.sqrt(N_STATS / 8.0)
    phases = rng.uniform(0.0, 2.0 * np.pi, features)
    zero = np.zeros(N_STATS)
    empty = np.zeros(0)
    model = QualityModel(zero, zero + 1.0, directions, phases, None, empty, empty, hits / total if total else 0.5)
    if not 0 < hits < total:
        return model
    docs = docs.select(F.col(key).alias("k"), F.col(text).alias("text"))
    if total > max_rows:
        picked = F.pmod(F.xxhash64("k", F.lit(seed)), F.lit(1 << 20)) < int(max_rows / total * (1 << 20))
        docs, labels = docs.where(picked), labels.where(picked)
    # Bounded by max_rows, so that a handful of partitions sums it.
    rows = written(with_statistics(docs, "text", ["k"]).join(labels, "k").select("stats", "label").coalesce(8), "quality_stats")

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q, h = 0, np.zeros(N_STATS), np.zeros(N_STATS), 0.0
        for batch in batches:
            x = _matrix(batch)
            n, s, q = n + len(x), s + x.sum(0), q + (x * x).sum(0)
            h += batch.column("label").to_numpy(zero_copy_only=False).sum()
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([[n, h], s, q]).tobytes()], pa.binary())], names=["m"])

    m = sum(np.frombuffer(bytes(r.m)) for r in rows.mapInArrow(moments, "m binary").collect())
    if not isinstance(m, np.ndarray) or not 0 < m[1] < m[0]:
        return model
    model.mean = m[2 : 2 + N_STATS] / m[0]
    model.scale = np.sqrt(np.maximum(m[2 + N_STATS :] / m[0] - model.mean**2, 1e-8))
    size = features + N_STATS + 1
    gram, target = _normal_equations(rows, model, size)
    model.weights = np.linalg.solve(gram + ridge * m[0] * np.eye(size) / size, target)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, h = np.zeros(bins), np.zeros(bins)
        for batch in batches:
            at = np.clip(((model.raw(_matrix(batch)) + 0.5) / 2.0 * bins).astype(int), 0, bins - 1)
            n += np.bincount(at, minlength=bins)
            h += np.bincount(at, batch.column("label").to_numpy(zero_copy_only=False), bins)
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([n, h]).tobytes()], pa.binary())], names=["m"])

    counts = sum(np.frombuffer(bytes(r.m)) for r in rows.mapInArrow(binned, "m binary").collect())
    n, h = counts[:bins], counts[bins:]
    centres = (np.arange(bins) + 0.5) * 2.0 / bins - 0.5
    model.steps, model.levels = pool_adjacent(centres[n > 0], h[n > 0], n[n > 0])
    return model


def score(docs: DataFrame, model: QualityModel, text: str = "text", threshold: float = 0.7, into: str = "score") -> DataFrame:
    """The documents with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on)."""
    fields = [f for f in docs.schema.fields if f.name.lower() not in (into, "predicted")]
    names = [f.name for f in fields]
    docs = docs.select(*[F.col(f"`{c}`") for c in names])
    schema = T.StructType([*fields, T.StructField(into, T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        p = np.clip(model.score(_all_statistics(batch.column(batch.schema.get_field_index(text)))), 0.0, 1.0)
        columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
        columns += [pa.array(p), pa.array((p >= threshold).astype(np.int32))]
        yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return _map_rows(docs, each, schema)


def held_out(key: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """True for the fold that is never learned from."""
    return F.crc32(F.col(key).cast("string")) % parts == part
