"""The tree's answers against brute force."""

import numpy as np
from pyspark.sql import functions as F

from orderlake.llm import ann_tree
from orderlake.llm.queries import QUERIES


def brute(ids, x, queries, k=10):
    out = {}
    for q in queries:
        d = np.sqrt(((x - x[ids.index(q)]) ** 2).sum(1))
        out[q] = sorted((float(d[i]), n) for i, n in enumerate(ids) if n != q)[:k]
    return out


def frame(spark, ids, x):
    return spark.createDataFrame([(i, [float(a) for a in v]) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<float>")


def test_full_visits_are_exact(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 8)).astype(np.float32).astype(np.float64)
    x[100:300] = x[100]
    ids = list(range(600))
    index = ann_tree.build(frame(spark, ids, x), leaf_size=8, branches=3)
    index.visits = index.tree.leaves
    got = {}
    for r in ann_tree.search(index, F.col("vec_id") % 50 == 0, block_rows=32, query_rows=2).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    for q, want in brute(ids, x, range(0, 600, 50)).items():
        assert [(s, n) for _, s, n in sorted(got[q])] == want
        assert [r for r, _, _ in sorted(got[q])] == list(range(1, 11))


def test_odd_rows_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], "a"), (1, [1.0, 0.5], "b"), (2, None, "c"), (3, [0.0, 0.0], "d"), (4, [nan, 1.0], "e"), (5, [inf, 1.0], "f")]
    rows += [(6, [None, 1.0], "g"), (7, [], "h"), (8, [1.0, 2.0, 3.0], "i"), (None, [1.0, 0.1], "j"), (100, [1.0, 0.0], "k"), (9, [1.0, 0.0], "l")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = [tuple(r) for r in ann_tree.search(ann_tree.build(table), F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 9, 0.0), (0, 2, 100, 0.0), (0, 3, 1, 0.5), (100, 1, 0, 0.0), (100, 2, 9, 0.0), (100, 3, 1, 0.5)]
    empty = table.limit(0)
    assert ann_tree.search(ann_tree.build(empty), F.col("vec_id") % 100 == 0).count() == 0


def test_query_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows], np.float32).astype(np.float64)
    want = brute(ids, x, [i for i in ids if i % 100 == 0])
    got = {}
    for r in QUERIES["op5_ann_tree"](spark, sf).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    assert got.keys() == want.keys()
    met = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 11))
        exact = {n: s for s, n in brute(ids, x, [q], k=len(ids))[q]}
        assert all(s == exact[n] for _, s, n in found)
        assert [(s, n) for _, s, n in found] == sorted((s, n) for _, s, n in found)
        met += len({n for _, _, n in found} & {n for _, n in want[q]})
    assert met / (10 * len(want)) >= 0.9


def test_visits_fall_short_of_the_whole_tree_where_data_has_clusters(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16)) * 10
    x = (centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16))).astype(np.float32)
    index = ann_tree.build(frame(spark, range(4000), x))
    assert index.recall >= 0.97 and index.visits < index.tree.leaves / 3
    assert index.sizes.sum() == 4000
