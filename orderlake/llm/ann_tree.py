"""Approximate nearest neighbours: a hierarchical k-means tree searched best bin first.

The tree is fitted on a bounded sample and then every vector is put into its leaf. A query keeps a priority queue of tree nodes by the distance to
their centres and visits leaves in that order. How many leaves is measured, not guessed: for some queries the true neighbours
are found by comparing with everything, and visits widen until the wanted share of them is met.

Vectors are dealt out as (leaf, block) with blocks of bounded size, so a leaf that holds a third of all vectors, as
copies of one do, is read by many tasks; queries of a leaf are dealt out in blocks too. A task keeps the nearest of each query it
has seen and reports those alone. Only the sample, the tree and counts per leaf are held by the driver; all are bounded
by parameters.

Defined cases: vectors that are null, zero, of another length than most of the sample, or hold null or non-finite numbers take no
part, nor do rows without key. Rows that share the query's key are its own. Ties go to the smaller key. With
no more than ``leaf_rows`` vectors the tree is one leaf and the search exact. Other columns are not part of the result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import written


@dataclass
class Tree:
    """Nodes of a k-means tree: centres, children (none for a leaf) and the number of each leaf."""

    centres: np.ndarray
    children: list[np.ndarray]
    leaf_of: np.ndarray

    @property
    def leaves(self) -> int:
        return int((self.leaf_of >= 0).sum())

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest child is followed at every level."""
        at, todo = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(todo):
            for node in np.unique(at[todo]).tolist():
                kids = self.children[node]
                if len(kids):
                    here = todo[at[todo] == node]
                    at[here] = kids[_nearest(x[here], self.centres[kids])]
            todo = todo[[len(self.children[n]) > 0 for n in at[todo].tolist()]]
        return self.leaf_of[at]

    def visits(self, q: np.ndarray) -> Iterator[int]:
        """Leaves in best-bin-first order."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            kids = self.children[node]
            if not len(kids):
                yield int(self.leaf_of[node])
                continue
            for d, kid in zip(((self.centres[kids] - q) ** 2).sum(1).tolist(), kids.tolist(), strict=True):
                heapq.heappush(queue, (d, kid))


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(1) - 2.0 * (x @ centres.T), axis=1)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        own = _nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=k)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres, _nearest(x, centres)


def fit_tree(sample: np.ndarray, branches: int, leaf_size: int, seed: int) -> Tree:
    """Split until a node holds at most ``leaf_size`` sample vectors, or only copies of one."""
    rng = np.random.default_rng(seed)
    centres, children, leaf_of = [sample.mean(0) if len(sample) else np.zeros(sample.shape[1])], [np.zeros(0, np.int64)], [0]
    todo, leaves = [(0, sample)], 0
    while todo:
        node, x = todo.pop()
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        if len(x) > leaf_size and (x != x[0]).any():
            middle, own = _kmeans(x, min(branches, len(x)), rng)
            parts = [(middle[i], x[own == i]) for i in np.unique(own)]
        if len(parts) < 2:
            leaf_of[node] = leaves
            leaves += 1
            continue
        leaf_of[node] = -1
        children[node] = np.arange(len(centres), len(centres) + len(parts))
        for centre, members in parts:
            todo.append((len(centres), members))
            centres.append(centre)
            children.append(np.zeros(0, np.int64))
            leaf_of.append(0)
    return Tree(np.array(centres), children, np.array(leaf_of))


def usable(vector: str, key: str) -> Column:
    """Vectors that take part in the search."""
    v = F.col(vector)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(key).isNotNull() & v.isNotNull() & ~F.coalesce(odd, F.lit(True)) & F.exists(v, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def exact_distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - q) ** 2).sum(axis=-1))


class Nearest:
    """The k nearest candidates of each query so far."""

    def __init__(self, k: int):
        self.k, self.found = k, {}

    def add(self, ids: np.ndarray, q: np.ndarray, keys: np.ndarray, x: np.ndarray) -> None:
        rough = (q**2).sum(1)[:, None] + (x**2).sum(1)[None, :] - 2.0 * (q @ x.T)
        rough[ids[:, None] == keys[None, :]] = np.inf
        scale = 1e-9 * (1.0 + (q**2).sum(1) + (x**2).sum(1).max())
        k = min(self.k, len(keys))
        # What rounding could have kept out of the k nearest is measured exactly too.
        border = np.partition(rough, k - 1, axis=1)[:, k - 1] + scale
        for i, name in enumerate(ids.tolist()):
            at = np.flatnonzero((rough[i] <= border[i]) & np.isfinite(rough[i]))
            d = exact_distances(q[i], x[at])
            before = self.found.get(name)
            if before is not None:
                keep = d <= before[1][-1] if len(before[1]) == self.k else slice(None)
                at, d = at[keep], d[keep]
                all_keys, d = np.concatenate([before[0], keys[at]]), np.concatenate([before[1], d])
            else:
                all_keys = keys[at]
            order = np.lexsort((all_keys, d))[: self.k]
            self.found[name] = (all_keys[order], d[order])

    def flush(self) -> pa.RecordBatch:
        names = np.repeat(np.array(list(self.found), np.int64), [len(v[0]) for v in self.found.values()])
        keys = np.concatenate([v[0] for v in self.found.values()] or [np.zeros(0, np.int64)])
        scores = np.concatenate([v[1] for v in self.found.values()] or [np.zeros(0)])
        self.found = {}
        return pa.RecordBatch.from_arrays([pa.array(names), pa.array(keys), pa.array(scores)], names=["query_id", "vec_id", "score"])


NEAR = "query_id long, vec_id long, score double"


def _ranked(near: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def brute_force(vectors: DataFrame, ids: np.ndarray, q: np.ndarray, k: int) -> DataFrame:
    """The true nearest of some queries, by comparing them with every vector (columns ``vec_id``, ``v``)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(k)
        for batch in batches:
            if len(batch):
                nearest.add(ids, q, batch.column(0).to_numpy(), _matrix(batch.column(1)))
        yield nearest.flush()

    return _ranked(vectors.select("vec_id", "v").mapInArrow(each, NEAR), k)


def _picked(df: DataFrame, rows: int, total: int, seed: int) -> DataFrame:
    """About ``rows`` of ``total`` rows, by a hash of the key."""
    share = min(1.0, rows / max(total, 1))
    return df.where(F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)))


def _collected(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    table = df.orderBy("vec_id").toArrow()
    ids = table.column("vec_id").to_numpy()
    return ids, _matrix(table.column("v").combine_chunks()) if len(ids) else np.zeros((0, 1))


@dataclass
class Index:
    """Every usable vector with its leaf, the tree, rows per leaf, and how many leaves a query visits."""

    vectors: DataFrame
    tree: Tree
    sizes: np.ndarray
    visits: int
    recall: float


def build(
    table: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 10,
    target_recall: float = 0.97,
    max_sample: int = 20_000,
    calibration_queries: int = 200,
    branches: int = 8,
    leaf_size: int = 48,
    seed: int = 3,
) -> Index:
    """Fit the tree on about ``max_sample`` vectors, index all, and calibrate the number of visits."""
    rows = table.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    rows = rows.where(usable("v", "vec_id"))
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not lengths:
        empty = Tree(np.zeros((1, 1)), [np.zeros(0, np.int64)], np.array([0]))
        return Index(rows.withColumn("leaf", F.lit(0)), empty, np.zeros(1, np.int64), 1, 1.0)
    rows, total = rows.where(F.size("v") == lengths[0].n), lengths[0]["count"]
    _, sample = _collected(_picked(rows, max_sample, total, seed))
    tree = fit_tree(sample if len(sample) else np.zeros((0, lengths[0].n)), branches, leaf_size, seed)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.assign(_matrix(batch.column(1))) if len(batch) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf.astype(np.int32))], names=["vec_id", "v", "leaf"])

    kind = rows.schema["v"].dataType.simpleString()
    vectors = written(rows.mapInArrow(place, f"vec_id long, v {kind}, leaf int"), "ann_index")
    sizes = np.zeros(tree.leaves, np.int64)
    for r in vectors.groupBy("leaf").count().collect():  # one number per leaf
        sizes[r.leaf] = r["count"]
    ids, q = _collected(_picked(vectors.select("vec_id", "v"), calibration_queries, total, seed + 1))
    if not len(ids):
        return Index(vectors, tree, sizes, tree.leaves, 1.0)
    true = brute_force(vectors, ids, q, k).join(vectors.select("vec_id", "leaf"), "vec_id").select("query_id", "leaf").collect()
    order = {int(i): {leaf: n for n, leaf in enumerate(tree.visits(v))} for i, v in zip(ids, q, strict=True)}
    places = np.sort([order[r.query_id][r.leaf] for r in true])
    needed = int(places[min(len(places) - 1, int(np.ceil(target_recall * len(places))) - 1)]) + 1 if len(places) else tree.leaves
    return Index(vectors, tree, sizes, needed, float((places < needed).mean()) if len(places) else 1.0)


def search(index: Index, queries: Column, k: int = 10, block_rows: int = 4096, query_rows: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score) for the indexed rows that satisfy ``queries``."""
    tree, sizes, wanted = index.tree, index.sizes, index.visits
    asked = index.vectors.where(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    kind = index.vectors.schema["v"].dataType.simpleString()

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, leaves = [], []
            for i, v in enumerate(_matrix(batch.column(1)) if len(batch) else []):
                met = n = 0
                for leaf in tree.visits(v):
                    if n >= wanted and met > k:
                        break
                    if sizes[leaf]:
                        at.append(i)
                        leaves.append(leaf)
                    met, n = met + sizes[leaf], n + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), batch.column(1).take(pa.array(at, pa.int64())), pa.array(leaves, pa.int32())],
                names=["vec_id", "v", "leaf"],
            )

    visits = written(asked.mapInArrow(walk, f"vec_id long, v {kind}, leaf int"), "ann_visits")
    per_leaf = {r.leaf: r["count"] for r in visits.groupBy("leaf").count().collect()}
    # Numbers of blocks per leaf, for vectors and for queries; as long as the tree has leaves.
    n_blocks = [max(1, -(-int(s) // block_rows)) for s in sizes]
    n_groups = [max(1, -(-per_leaf.get(leaf, 0) // query_rows)) for leaf in range(len(sizes))]
    counts = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(g).alias("g")) for b, g in zip(n_blocks, n_groups, strict=True)])

    def dealt(df: DataFrame, mine: str, other: str, query: bool) -> DataFrame:
        n = F.get(counts, F.col("leaf"))
        own = F.pmod(F.xxhash64("vec_id", F.lit(7)), n[mine]).cast("int")
        df = df.select("leaf", own.alias(mine), F.explode(F.sequence(F.lit(0), n[other] - 1)).alias(other), "vec_id", "v")
        return df.select("leaf", "b", "g", F.lit(not query).alias("candidate"), "vec_id", "v")

    candidates = index.vectors.where(F.col("leaf").isin(list(per_leaf))) if len(per_leaf) < tree.leaves else index.vectors
    both = dealt(candidates, "b", "g", False).unionByName(dealt(visits, "g", "b", True))
    parts = int(visits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = both.repartition(parts, "leaf", "b", "g").sortWithinPartitions("leaf", "b", "g", "candidate")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest, here, ids, q = Nearest(k), None, [], []
        for batch in batches:
            if not len(batch):
                continue
            place = np.stack([batch.column(c).to_numpy() for c in ("leaf", "b", "g")], axis=1)
            kinds = batch.column("candidate").to_numpy(zero_copy_only=False).astype(np.int64)
            change = np.flatnonzero((np.diff(place, axis=0) != 0).any(axis=1) | (np.diff(kinds) != 0)) + 1
            keys, x = batch.column("vec_id").to_numpy(), _matrix(batch.column("v"))
            for a, e in zip([0, *change.tolist()], [*change.tolist(), len(batch)], strict=True):
                if here != tuple(place[a]):
                    here, ids, q = tuple(place[a]), [], []
                if not kinds[a]:
                    ids.append(keys[a:e])
                    q.append(x[a:e])
                elif ids:
                    nearest.add(np.concatenate(ids), np.concatenate(q), keys[a:e], x[a:e])
                    if len(nearest.found) > 100_000:
                        yield nearest.flush()
        yield nearest.flush()

    return _ranked(both.mapInArrow(meet, NEAR), k)
