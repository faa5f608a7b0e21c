"""Ranked lexical search for many items at once by a dual tree: exact top k, with pairs of nodes discarded by bounds.

A term adds ``w * ((scale * tf) div (1000 * tf + 12 * m))`` to a document's score, ``w`` falling with the number of
documents that hold the term and ``m`` growing with the document's length (see ``search``). No part is negative, so the
coordinate maxima of a set of documents (per term the greatest value of the second factor) and of a set of items (per term
the greatest weight) bound every score between the two sets from above. Both sides are hierarchies of such maxima:

* items: leaves of 8, above them nodes of 64, ordered so that items with common terms are neighbours;
* documents: leaves of 16 and nodes of 128 below groups of up to 1024, ordered by each document's heaviest term, so that texts of
  one language or with one passage are neighbours.

A group meets the items' upper nodes, its nodes those nodes' leaves, its leaves the single items; what is left is scored. A
pair goes as soon as its bound is below the weakest k-th score among its items. Those k-th scores come from a first pass, in which
each item visits only the best leaf of each group, and rise with what a task has found itself. Equal bounds stay, so that ties are
still decided by the key.

Texts are read once for the terms of all items (a written table), which both passes read. A task returns at most k
documents per item; nothing else is shuffled. Items pass through the driver in blocks of at most 4096 and about 2 MB of text, which
bounds what is broadcast; a longer item is a block of its own.

Defined cases: a null or empty text, or one without terms, matches nothing and does not count as a document. Every row is a
document or an item of its own, repeated keys included; equal scores are ranked by ascending key, a null key first. Texts
of any length are read whole, one text in one task. Without documents or items there are no rows. Other input columns are not
read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from orderlake.llm import terms
from orderlake.llm.common import drop_tables, written

SCALE = 1_000_000_000
#: Items of an item leaf, and leaves of an upper node.
ITEM_LEAF, ITEM_FAN = 8, 8
#: Documents of a document leaf, leaves of a node, nodes of a group.
DOC_LEAF, DOC_FAN, GROUP_FAN = 16, 8, 8
#: Most items and bytes of item texts that are searched for in one go.
BLOCK_ITEMS, BLOCK_BYTES = 4096, 2 << 20
#: Most numbers in a group's table of documents and terms.
CELLS = 1 << 22


@dataclass
class Rows:
    """Sparse rows: term numbers and values one row after the other."""

    starts: np.ndarray
    ids: np.ndarray
    values: np.ndarray

    @staticmethod
    def of(rows: list[tuple[np.ndarray, np.ndarray]]) -> Rows:
        sizes = [len(i) for i, _ in rows]
        empty = np.zeros(0, np.int64)
        ids = np.concatenate([i for i, _ in rows] or [empty])
        return Rows(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), ids, np.concatenate([v for _, v in rows] or [empty]))

    def __len__(self) -> int:
        return len(self.starts) - 1

    def maxima(self, bounds: np.ndarray) -> Rows:
        """The coordinate maxima of neighbouring rows."""
        out = []
        for a, e in zip(bounds[:-1], bounds[1:], strict=True):
            ids, values = (x[self.starts[a] : self.starts[e]] for x in (self.ids, self.values))
            kinds, at = np.unique(ids, return_inverse=True)
            most = np.zeros(len(kinds), np.int64)
            np.maximum.at(most, at, values)
            out.append((kinds, most))
        return Rows.of(out)

    def pick(self, chosen: np.ndarray) -> Rows:
        """Some of the rows."""
        sizes = self.starts[chosen + 1] - self.starts[chosen]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(self.starts[chosen] - starts[:-1], sizes) + np.arange(starts[-1])
        return Rows(starts, self.ids[at], self.values[at])

    def times(self, table: np.ndarray) -> np.ndarray:
        """Products with the rows of a dense table: one column per row of this one. No row may be empty."""
        if not len(self):
            return np.zeros((len(table), 0), np.int64)
        return np.add.reduceat(table[:, self.ids] * self.values, self.starts[:-1], axis=1)


@dataclass
class Items:
    """A block of items with terms, in tree order, as every task needs it."""

    numbers: list[int]
    keys: list
    vocabulary: dict[bytes, int]
    rows: Rows = None
    leaves: Rows = None
    nodes: Rows = None
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def weigh(self, counts: Rows, weights: np.ndarray) -> None:
        self.weights = weights
        self.rows = Rows(counts.starts, counts.ids, counts.values * weights[counts.ids])
        self.leaves = self.rows.maxima(_bounds(len(self.rows), ITEM_LEAF))
        self.nodes = self.leaves.maxima(_bounds(len(self.leaves), ITEM_FAN))


def _bounds(n: int, size: int) -> np.ndarray:
    return np.append(np.arange(0, n, size), n)


def _children(chosen: np.ndarray, fan: int, n: int) -> np.ndarray:
    below = (chosen[:, None] * fan + np.arange(fan)).ravel()
    return below[below < n]


def _tree_order(sets: list[frozenset[int]]) -> list[int]:
    """Items in an order in which neighbours share terms: split again and again by the term that is nearest to every second item."""
    done, todo = [], [list(range(len(sets)))]
    while todo:
        here = todo.pop()
        if len(here) <= ITEM_LEAF:
            done += here
            continue
        seen: dict[int, int] = {}
        for i in here:
            for t in sets[i]:
                seen[t] = seen.get(t, 0) + 1
        term = min(seen, key=lambda t: (abs(2 * seen[t] - len(here)), t))
        inside = [i for i in here if term in sets[i]]
        outside = [i for i in here if term not in sets[i]]
        if not outside or not inside:
            inside, outside = here[: len(here) // 2], here[len(here) // 2 :]
        todo += [outside, inside]
    return done


def _blocks(items: DataFrame, key: str, text: str) -> Iterator[list[tuple]]:
    """The items in blocks of bounded size, as (key, text in bytes)."""
    block, size = [], 0
    for row in items.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("binary").alias("t")).toLocalIterator():
        t = bytes(row.t or b"")
        if block and (len(block) >= BLOCK_ITEMS or size + len(t) > BLOCK_BYTES):
            yield block
            block, size = [], 0
        block.append((row.k, t))
        size += len(t)
    if block:
        yield block


def _read_items(block: list[tuple], first: int) -> tuple[Items, Rows]:
    """The block's items that have terms, in tree order, and how often each has its terms."""
    kinds, codes, counts = terms.terms([t for _, t in block], terms.LETTERS_AND_DIGITS)
    owner, ids, n = terms.tally(codes, counts, len(kinds))
    bounds = np.searchsorted(owner, np.arange(len(block) + 1))
    rows = [(ids[a:e], n[a:e].astype(np.int64)) for a, e in zip(bounds[:-1], bounds[1:], strict=True)]
    holding = [i for i, (t, _) in enumerate(rows) if len(t)]
    order = [holding[i] for i in _tree_order([frozenset(rows[i][0].tolist()) for i in holding])]
    vocabulary = {t: i for i, t in enumerate(kinds.to_pylist())}
    return Items([first + i for i in order], [block[i][0] for i in order], vocabulary), Rows.of([rows[i] for i in order])


def _postings(docs: DataFrame, key: str, text: str, vocabulary) -> DataFrame:
    """Per document its key, its number of terms, and the items' terms in it with their counts."""
    fields = [T.StructField("key", docs.schema[key].dataType), T.StructField("n", T.LongType())]
    fields += [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("ids", "tfs")]
    schema = T.StructType(fields)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number_of = vocabulary.value.get
        for batch in batches:
            for part in terms.slices(batch, 1):
                kinds, codes, counts = terms.terms(terms.bytes_of(part.column(1)), terms.LETTERS_AND_DIGITS)
                known = np.fromiter((number_of(t, -1) for t in kinds.to_pylist()), np.int64, len(kinds))
                owner, code, n = terms.tally(codes, counts, len(kinds))
                held = known[code] >= 0
                ids, tfs = pa.array(known[code[held]], pa.int32()), pa.array(n[held], pa.int32())
                columns = [part.column(0), pa.array(counts), *terms.lists(owner[held], len(counts), ids, tfs)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names).filter(pa.array(counts > 0))

    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("binary").alias("text"))
    return rows.mapInArrow(each, schema)


@dataclass
class Corpus:
    documents: int
    terms: int

    def lengths(self, n: np.ndarray) -> np.ndarray:
        """m of documents with n terms; whole numbers of any size on the way."""
        most = int(n.max(initial=0)) * 25 * self.documents
        big = n.astype(object) if most >= 1 << 63 else n
        return (75 + (25 * big * self.documents) // self.terms).astype(np.int64)

    def weight(self, holding: int) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * holding + 1)))


class _Best:
    """The k best documents of each item so far, and the score from which on a document still counts."""

    def __init__(self, items: Items, k: int, least: np.ndarray):
        self.items, self.k, self.least = items, k, least.copy()
        self.found: dict[int, tuple[np.ndarray, list]] = {}
        self.refresh()

    def refresh(self) -> None:
        self.of_leaf = np.minimum.reduceat(self.least, _bounds(len(self.least), ITEM_LEAF)[:-1])
        self.of_node = np.minimum.reduceat(self.of_leaf, _bounds(len(self.of_leaf), ITEM_FAN)[:-1])

    def add(self, chosen: np.ndarray, scores: np.ndarray, keys: list) -> None:
        """Scores of some documents (rows) for the chosen items (columns)."""
        good = scores >= self.least[chosen]
        for c in np.flatnonzero(good.any(0)).tolist():
            item, rows = int(chosen[c]), np.flatnonzero(good[:, c])
            score, named = scores[rows, c], [keys[r] for r in rows.tolist()]
            if item in self.found:
                score, named = np.concatenate([self.found[item][0], score]), self.found[item][1] + named
            order = sorted(range(len(score)), key=lambda i: (-score[i], named[i] is not None, named[i]))[: self.k]
            self.found[item] = score[order], [named[i] for i in order]
            if len(order) == self.k:
                self.least[item] = max(self.least[item], score[order[-1]])

    def rows(self, schema: T.StructType) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), *(to_arrow_type(f.dataType) for f in schema.fields[1:])]
        for item, (score, keys) in self.found.items():
            n = len(keys)
            columns = [[self.items.numbers[item]] * n, [self.items.keys[item]] * n, keys, score.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=schema.names)


class _Group:
    """A group of documents: values per document and term, and the maxima of its leaves and nodes."""

    def __init__(self, keys: list, table: np.ndarray):
        self.keys, self.table = keys, table
        self.leaves = np.maximum.reduceat(table, _bounds(len(table), DOC_LEAF)[:-1], axis=0)
        self.nodes = np.maximum.reduceat(self.leaves, _bounds(len(self.leaves), DOC_FAN)[:-1], axis=0)
        self.top = self.nodes.max(0, keepdims=True)

    def docs(self, leaf: int) -> slice:
        return slice(leaf * DOC_LEAF, (leaf + 1) * DOC_LEAF)


def _groups(batch: pa.RecordBatch, corpus: Corpus, weights: np.ndarray) -> Iterator[_Group]:
    """The batch's documents ordered by their heaviest term and cut into groups."""
    held = batch.column("ids").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.flatnonzero(held)
    if not len(rows):
        return
    ids = batch.column("ids").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    tfs = batch.column("tfs").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    m = corpus.lengths(batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64))
    values = (SCALE * tfs) // (1000 * tfs + 12 * np.repeat(m, held))
    starts = np.concatenate([[0], np.cumsum(held)])
    # One number per term: the heavier, the greater; of equal weights the lower id.
    standing = np.empty(len(weights), np.int64)
    standing[np.lexsort((-np.arange(len(weights)), weights))] = np.arange(len(weights))
    heaviest = np.maximum.reduceat(standing[ids], starts[rows])
    rows = rows[np.argsort(heaviest, kind="stable")]
    keys = batch.column("key").to_pylist()
    size = max(DOC_LEAF, min(DOC_LEAF * DOC_FAN * GROUP_FAN, CELLS // len(weights)))
    for at in range(0, len(rows), size):
        here = rows[at : at + size]
        table = np.zeros((len(here), len(weights)), np.int64)
        n = held[here]
        places = np.repeat(starts[here] - np.concatenate([[0], np.cumsum(n)])[:-1], n) + np.arange(n.sum())
        table[np.repeat(np.arange(len(here)), n), ids[places]] = values[places]
        yield _Group([keys[r] for r in here.tolist()], table)


def _visit_best_leaves(group: _Group, items: Items, best: _Best) -> None:
    """First pass: each item's best leaf only."""
    for node in range(len(items.nodes)):
        own = _children(_children(np.array([node]), ITEM_FAN, len(items.leaves)), ITEM_LEAF, len(items.rows))
        bounds = items.rows.pick(own).times(group.leaves)
        leaf_of = bounds.argmax(0)
        for leaf in np.unique(leaf_of).tolist():
            chosen = own[(leaf_of == leaf) & (bounds[leaf] >= best.least[own])]
            if len(chosen):
                here = group.docs(leaf)
                best.add(chosen, items.rows.pick(chosen).times(group.table[here]), group.keys[here])


def _visit(group: _Group, items: Items, best: _Best, seen: np.ndarray) -> None:
    """Second pass: every pair of nodes whose bound reaches the weakest k-th score of its items."""
    best.refresh()
    nodes = np.flatnonzero(items.nodes.times(group.top)[0] >= best.of_node)
    leaves = _children(nodes, ITEM_FAN, len(items.leaves))
    seen[0] += len(group.table) * len(items.rows)
    if not len(leaves):
        return
    of_leaves = items.leaves.pick(leaves)
    for node, alive in enumerate(of_leaves.times(group.nodes) >= best.of_leaf[leaves]):
        chosen = _children(leaves[alive], ITEM_LEAF, len(items.rows))
        if not len(chosen):
            continue
        own = slice(node * DOC_FAN, (node + 1) * DOC_FAN)
        bounds = items.rows.pick(chosen).times(group.leaves[own])
        for i, bound in enumerate(bounds):
            left = chosen[bound >= best.least[chosen]]
            if len(left):
                here = group.docs(node * DOC_FAN + i)
                best.add(left, items.rows.pick(left).times(group.table[here]), group.keys[here])
                seen[1] += len(left) * len(group.keys[here])


def _pass(postings: DataFrame, items, corpus: Corpus, k: int, least, schema: T.StructType, first: bool, counters=()) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here: Items = items.value
        best, seen = _Best(here, k, least.value if least else np.ones(len(here.rows), np.int64)), np.zeros(2, np.int64)
        for batch in batches:
            for group in _groups(batch, corpus, here.weights):
                if first:
                    _visit_best_leaves(group, here, best)
                else:
                    _visit(group, here, best, seen)
        for counter, n in zip(counters, seen.tolist(), strict=False):
            counter.add(n)
        yield from best.rows(schema)

    return postings.mapInArrow(each, schema)


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("number").orderBy(F.col("score").desc(), F.col("key").asc_nulls_first())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    docs: DataFrame, items: DataFrame, k: int = 20, key: str = "doc_id", text: str = "text", item_key: str = "item_id", counters: tuple = ()
) -> DataFrame:
    """For each item its ``k`` best documents: the item's key, ``rank`` (from 1), the document's key and ``score`` (above 0).

    With N documents that have terms, L terms in all of them, and df documents holding a term, ``w`` is
    floor(1000 * ln((2N + 2) / (2df + 1))) and ``m`` of a document with n terms is 75 + (25 * n * N) div L. ``counters``, two
    accumulators, get the number of pairs of a document that holds any item's term and an item, and of those that were scored.
    """
    spark, parts = docs.sparkSession, []
    schema = T.StructType(
        [
            T.StructField("number", T.IntegerType()),
            T.StructField("item", items.schema[item_key].dataType),
            T.StructField("key", docs.schema[key].dataType),
            T.StructField("score", T.LongType()),
        ]
    )
    first = 0
    for block in _blocks(items, item_key, text):
        found = _search_block(docs, block, first, k, key, text, schema, counters)
        first += len(block)
        if found is not None:
            parts.append(found)
    out = parts[0] if parts else spark.createDataFrame([], schema)
    for more in parts[1:]:
        out = out.unionByName(more)
    # Each table holds the best of its own items already; the rank is counted once more over all of them.
    return _top(out, k).select(F.col("item").alias(item_key), "rank", F.col("key").alias(key), "score")


def _search_block(docs: DataFrame, block: list[tuple], first: int, k: int, key: str, text: str, schema: T.StructType, counters: tuple) -> DataFrame | None:
    context = docs.sparkSession.sparkContext
    items, counts = _read_items(block, first)
    if not len(counts):
        return None
    vocabulary = context.broadcast(items.vocabulary)
    postings = written(_postings(docs, key, text, vocabulary), "postings")
    n, total = postings.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).head()
    holding = postings.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    corpus, weights = Corpus(n, total), np.zeros(len(items.vocabulary), np.int64)
    for row in holding.toLocalIterator():  # at most one row per term of the block
        weights[row.id] = corpus.weight(row.n)
    items.weigh(counts, weights)
    items.vocabulary = {}
    shared = context.broadcast(items)
    seeds = _top(_pass(postings, shared, corpus, k, None, schema, True), k).where(F.col("rank") == k).select("number", "score")
    kth = {r.number: r.score for r in seeds.toLocalIterator()}  # at most one row per item of the block
    least = context.broadcast(np.array([kth.get(i, 1) for i in items.numbers], np.int64))
    found = written(_top(_pass(postings, shared, corpus, k, least, schema, False, counters), k).drop("rank"), "ranked")
    drop_tables([postings])
    return found
