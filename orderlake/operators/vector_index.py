"""A partitioned index of vectors for searches by cosine: coarse cells, short codes of what is left, exact scores at the end.

Vectors are scaled to length 1 and dealt to the nearest of some centroids; a cell is a partition of the index table. The difference to the
centroid is cut into pieces, each named by the nearest of at most 256 trained pieces. A search reads the cells nearest to the question only:
first their codes, whose scores come from one small table of the question's products with all trained pieces (asymmetric distance), then
the vectors of the short list, whose scores are exact.

The number of cells read is calibrated when the index is built: enough to hold ``recall`` of the true neighbours of some of the table's own
vectors. ``exact=True`` gives the true nearest instead: the k-th best score that was found, against the most that a cell's radius allows, says which
further cells have to be read.

What is fitted sees at most about ``max_sample`` vectors (picked by a hash of the key, so there is one row per key); all vectors are indexed,
and radii and calibration are taken from all of them. The model goes to the tasks; it has ``cells`` and 256 vectors, whatever the table holds.

Defined cases: vectors that are null, empty, of length zero or hold null or non-finite numbers aren't indexed, and an index of none finds
nothing. Vectors of several lengths are an error. Equal scores go by the key. Where fewer than k vectors lie in the cells read, all cells are.
"""

from __future__ import annotations

import io
import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.functions.scalars import cosine
from orderlake.sources import tables

# What the tasks run travels to them as it is here, so that executors needn't have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MOST_CELLS = 4096
_NEAR = 10  # neighbours that the calibration looks for


@dataclass(frozen=True)
class Model:
    """Centroids (cells x dimensions), trained pieces (pieces x words x width), and per cell the greatest distance of a vector in it."""

    centroids: np.ndarray
    words: np.ndarray
    radii: np.ndarray
    probes: int

    def cells_of(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each vector, and what is left of the vector, in pieces."""
        cell = _nearest(vectors, self.centroids)
        rest = vectors - self.centroids[cell]
        pieces, _, width = self.words.shape
        padded = np.zeros((len(rest), pieces * width))
        padded[:, : rest.shape[1]] = rest
        return cell, padded.reshape(len(rest), pieces, width)

    def packed(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, centroids=self.centroids, words=self.words, radii=self.radii, probes=self.probes)
        return out.getvalue()

    @staticmethod
    def unpacked(raw: bytes) -> Model:
        with np.load(io.BytesIO(raw)) as found:
            return Model(found["centroids"], found["words"], found["radii"], int(found["probes"]))


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each point, a bounded number of distances at a time."""
    lengths, out = (centres**2).sum(axis=1), np.empty(len(points), np.int64)
    step = max(1, (1 << 21) // max(1, len(centres)))
    for at in range(0, len(points), step):
        out[at : at + step] = (lengths - 2.0 * points[at : at + step] @ centres.T).argmin(axis=1)
    return out


def _trained(points: np.ndarray, most: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's rounds from an evenly dealt start."""
    centres = points[np.linspace(0, len(points) - 1, min(most, len(points))).astype(int)].copy()
    for _ in range(rounds):
        at = _nearest(points, centres)
        sums, counts = np.zeros_like(centres), np.bincount(at, minlength=len(centres))
        np.add.at(sums, at, points)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(column), -1)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``key``, ``embedding`` as it is and ``unit``, of length 1, of the vectors that have a direction."""
    value = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").alias("embedding"), value.alias("v")).where(sound)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    return rows.withColumn("norm", norm).where("norm > 0").select("key", "embedding", F.transform("v", lambda x: x / F.col("norm")).alias("unit"))


def _words(sample: DataFrame, centroids: np.ndarray, pieces: int) -> np.ndarray:
    """Trained pieces of what the centroids leave; each piece's place is fitted by a task of its own."""
    width = math.ceil(centroids.shape[1] / pieces)
    start = Model(centroids, np.zeros((pieces, 1, width)), np.zeros(0), 0)

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, found = start.cells_of(_matrix(batch.column(0)))
                place = np.tile(np.arange(pieces, dtype=np.int32), len(found))
                yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(list(found.reshape(-1, width)))], names=["piece", "part"])

    def fit(parts: pd.DataFrame) -> pd.DataFrame:
        points = np.stack(parts["part"].to_list())
        points = points[np.lexsort(points.T)]  # the same start whatever order rows come in
        return pd.DataFrame({"piece": [int(parts["piece"].iloc[0])], "words": [_trained(points, 256).tobytes()]})

    parts = sample.select("unit").mapInArrow(rest, "piece int, part array<double>")
    found = {r.piece: np.frombuffer(bytes(r.words)).reshape(-1, width) for r in parts.groupBy("piece").applyInPandas(fit, "piece int, words binary").collect()}
    return np.stack([found[i] for i in range(pieces)])


def _coded(rows: DataFrame, model: Model) -> DataFrame:
    schema = T.StructType(
        [*rows.select("key", "embedding").schema.fields, T.StructField("codes", T.ArrayType(T.ShortType())), T.StructField("gap", T.DoubleType()), T.StructField("cell", T.IntegerType())]
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, rest = model.cells_of(_matrix(batch.column("unit")))
            codes = np.stack([_nearest(rest[:, i], words) for i, words in enumerate(model.words)], axis=1).astype("int16")
            columns = [batch.column("key"), batch.column("embedding"), pa.array(list(codes)), pa.array(np.sqrt((rest**2).sum(axis=(1, 2)))), pa.array(cell.astype("int32"))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.select("key", "embedding", "unit").mapInArrow(each, schema)


def _calibrated(table: DataFrame, model: Model, questions: np.ndarray, recall: float) -> int:
    """How many of a question's nearest cells hold ``recall`` of its true neighbours, over all questions."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = np.zeros((len(questions), 0))
        cell = np.zeros((len(questions), 0), np.int64)
        for batch in batches:
            vectors = _matrix(batch.column(0))
            vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
            score = np.hstack([score, questions @ vectors.T])
            cell = np.hstack([cell, np.broadcast_to(batch.column(1).to_numpy(), (len(questions), len(vectors)))])
            best = np.argsort(-score, axis=1, kind="stable")[:, : _NEAR + 1]
            score, cell = np.take_along_axis(score, best, 1), np.take_along_axis(cell, best, 1)
        question = np.repeat(np.arange(len(questions)), score.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(question), pa.array(score.ravel()), pa.array(cell.ravel())], names=["q", "score", "cell"])

    found = table.select("embedding", "cell").mapInArrow(each, "q long, score double, cell long")
    top = F.slice(F.sort_array(F.collect_list(F.struct("score", "cell")), asc=False), 1, _NEAR + 1).getField("cell")
    near = found.groupBy("q").agg(top.alias("cells")).collect()  # a few cells per question
    ranks = np.argsort(np.argsort(-questions @ model.centroids.T + (model.centroids**2).sum(axis=1) / 2, axis=1), axis=1)
    needed = np.sort([ranks[r.q, c] for r in near for c in r.cells[1:]] or [0])  # the first one is the question itself
    return int(needed[math.ceil(recall * len(needed)) - 1]) + 1


@dataclass(frozen=True)
class VectorIndex:
    """An index that was written: its rows ``(key, embedding, codes, gap, cell)`` and its model."""

    rows: DataFrame
    model: Model

    def _cells(self, cells: Sequence[int]) -> DataFrame:
        return self.rows.where(F.col("cell").isin([int(c) for c in cells]))

    def among(self, keys: DataFrame) -> VectorIndex:
        """The index of those rows only that ``keys`` (a column ``key``) holds; cells that aren't asked for stay unread."""
        return VectorIndex(self.rows.join(keys.select("key"), "key", "left_semi"), self.model)

    def search(self, question: Sequence[float], k: int = 10, probes: int | None = None, shortlist: int = 200, exact: bool = False) -> DataFrame:
        """The k nearest: ``key``, ``score`` (the cosine of the stored vector), ``rank`` from 1."""
        model, q = self.model, np.asarray(question, "float64")
        if not len(model.centroids):
            return _best(self.rows, question, k)
        if q.shape != model.centroids.shape[1:] or not np.isfinite(q).all() or not q.any():
            raise ValueError("the question needs a direction in the vectors' space")
        unit = q / np.linalg.norm(q)
        away = np.linalg.norm(model.centroids - unit, axis=1)
        order = np.argsort(away, kind="stable")
        near = self._cells(order[: probes or model.probes])
        guess = near.select("key", "cell", _guess(model, unit).alias("guess")).orderBy(F.col("guess").desc(), "key").limit(max(k, shortlist))
        # The short list is a few hundred keys, so it is broadcast; the vectors are read in the same cells.
        found = _best(near.join(F.broadcast(guess.select("key")), "key", "left_semi"), question, k)
        enough = found.agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).head() if exact or len(order) > (probes or model.probes) else None
        if enough and enough.n < k:
            return _best(self.rows, question, k)
        if not exact:
            return found
        # A vector in a cell is not nearer to the question than the cell's centroid less the cell's radius.
        most = 1.0 - np.maximum(away - model.radii, 0.0) ** 2 / 2
        return _best(self._cells(np.flatnonzero(most >= enough.least - 1e-9)) if enough.n else self.rows, question, k)


def _numbers(values: np.ndarray) -> Column:
    """An array of numbers as one constant."""
    return F.split(F.lit(",".join(map(repr, values.ravel().tolist()))), ",").cast("array<double>")


def _guess(model: Model, unit: np.ndarray) -> Column:
    """The product with the centroid and with the trained pieces that stand for the rest."""
    pieces, words, width = model.words.shape
    padded = np.zeros(pieces * width)
    padded[: len(unit)] = unit
    products = _numbers(np.einsum("pwd,pd->pw", model.words, padded.reshape(pieces, width)))
    parts = F.transform("codes", lambda code, i: products[i * words + code.cast("int")])
    return F.aggregate(parts, _numbers(model.centroids @ unit)[F.col("cell")], lambda s, x: s + x)


def _best(rows: DataFrame, question: Sequence[float], k: int) -> DataFrame:
    scored = rows.select("key", F.col("embedding"), _numbers(np.asarray(question, "float64")).alias("q")).select("key", cosine("embedding", "q").alias("score"))
    best = scored.orderBy(F.col("score").desc(), "key").limit(k)
    listed = best.agg(F.collect_list(F.struct((-F.col("score")).alias("far"), "key")).alias("all"))  # k rows
    return listed.select(F.posexplode(F.array_sort("all"))).select("col.key", (-F.col("col.far")).alias("score"), (F.col("pos") + 1).alias("rank"))


def build(
    vectors: DataFrame,
    path: str,
    key: str = "comment_hash",
    vector: str = "embedding",
    cells: int | None = None,
    pieces: int = 16,
    recall: float = 0.97,
    max_sample: int = 50_000,
    questions: int = 100,
    seed: int = 6,
) -> VectorIndex:
    """Write an index below ``path``. Without ``cells`` there are as many as the square root of the number of vectors, 4096 at most."""
    spark = vectors.sparkSession
    # Written once: counting, fitting, coding and calibrating all read the same vectors, whatever they are derived from.
    tables.full_refresh(vectors.select(key, vector), f"{path}/in")
    rows = usable(spark.read.parquet(f"{path}/in"), key, vector)
    size = F.size("unit")
    n, low, high = rows.agg(F.count(F.lit(1)), F.min(size), F.max(size)).head()
    if low != high:
        raise ValueError(f"vectors have {low} to {high} dimensions")
    if not n:
        model = Model(np.zeros((0, 0)), np.zeros((0, 0, 0)), np.zeros(0), 0)
        tables.full_refresh(rows.select("key", "embedding", F.array().cast("array<smallint>").alias("codes"), F.lit(0.0).alias("gap"), F.lit(0).alias("cell")), f"{path}/rows", ["cell"])
    else:
        place = F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(n))
        sample = rows.where(place < max_sample) if n > max_sample else rows
        wanted = cells or min(MOST_CELLS, math.ceil(math.sqrt(n)))
        fitted = KMeans(k=max(2, wanted), maxIter=10, seed=seed).fit(sample.select(array_to_vector("unit").alias("features")))
        centroids = np.stack(fitted.clusterCenters())
        model = Model(centroids, _words(sample, centroids, min(pieces, low)), np.zeros(len(centroids)), len(centroids))
        tables.full_refresh(_coded(rows, model), f"{path}/rows", ["cell"])
        table = tables.read(spark, f"{path}/rows")
        radii = np.zeros(len(centroids))
        for r in table.groupBy("cell").agg(F.max("gap").alias("gap")).collect():  # one row per cell
            radii[r.cell] = r.gap
        asked = rows.where(place < questions).select("unit").limit(2 * questions).collect()
        probes = _calibrated(table, model, np.array([r.unit for r in asked]), recall) if asked else len(centroids)
        model = Model(centroids, model.words, radii, probes)
    tables.remove(spark, f"{path}/in")
    spark.createDataFrame([(bytearray(model.packed()),)], "model binary").write.mode("overwrite").parquet(f"{path}/model")
    return load(spark, path)


def load(spark: SparkSession, path: str) -> VectorIndex:
    model = Model.unpacked(bytes(spark.read.parquet(f"{path}/model").head().model))
    return VectorIndex(tables.read(spark, f"{path}/rows"), model)
