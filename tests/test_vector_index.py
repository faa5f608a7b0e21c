"""The partitioned vector index against all scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlake.operators import vector_index


def frame(spark, vectors):
    rows = [(f"k{i:06d}", None if v is None else [None if x is None else float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "comment_hash string, embedding array<float>").repartition(4)


def clustered(n, dimensions=32, groups=60, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dimensions))
    return (centres[rng.integers(0, groups, n)] + 0.35 * rng.normal(size=(n, dimensions))).astype("float32")


def true_nearest(vectors, question, k):
    v, q = vectors.astype("float64"), np.asarray(question, "float64")
    scores = v @ q / np.linalg.norm(v, axis=1) / np.linalg.norm(q)
    best = np.argsort(-scores, kind="stable")[:k]
    return [f"k{i:06d}" for i in best], scores[best]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    vectors = clustered(20_000)
    found = vector_index.build(frame(spark, vectors), str(tmp_path_factory.mktemp("index")))
    return vectors, found


def test_recall_with_most_cells_unread(index):
    vectors, found = index
    hits, cells = 0, len(found.model.centroids)
    asked = clustered(12, seed=1)[:12] + 0.05
    for q in asked:
        true, _ = true_nearest(vectors, q, 10)
        got = found.search(q.tolist()).collect()
        assert [r.rank for r in got] == list(range(1, 11))
        hits += len({r.key for r in got} & set(true))
    assert hits / (10 * len(asked)) >= 0.9
    assert found.model.probes < cells / 2
    plan = found.search(asked[0].tolist())._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan or "PartitionFilters: [cell" in plan


def test_exact_search_equals_all_scores(index):
    vectors, found = index
    for q in clustered(4, seed=9):
        keys, scores = true_nearest(vectors, q, 10)
        got = found.search(q.tolist(), probes=1, shortlist=10, exact=True).collect()
        assert [r.key for r in got] == keys
        assert np.allclose([r.score for r in got], scores, atol=1e-12)


def test_codes_guess_scores(index):
    vectors, found = index
    q = clustered(1, seed=3)[0].astype("float64")
    unit = q / np.linalg.norm(q)
    guessed = found.rows.select("key", vector_index._guess(found.model, unit).alias("g")).orderBy("key").toPandas()["g"].to_numpy()
    v = vectors.astype("float64")
    assert np.abs(guessed - v @ unit / np.linalg.norm(v, axis=1)).max() < 0.3
    assert np.corrcoef(guessed, v @ unit / np.linalg.norm(v, axis=1))[0, 1] > 0.98


def test_unusable_vectors_ties_and_few_rows(spark, tmp_path):
    vectors = [[1, 0], [1, 0], [0, 1], None, [0, 0], [float("nan"), 1], [float("inf"), 1], [None, 1], []]
    found = vector_index.build(frame(spark, vectors), str(tmp_path / "few"))
    assert found.rows.count() == 3
    for exact in (False, True):
        got = found.search([2.0, 0.0], exact=exact).collect()
        assert [(r.key, r.rank) for r in got] == [("k000000", 1), ("k000001", 2), ("k000002", 3)]
    with pytest.raises(ValueError):
        found.search([0.0, 0.0])
    with pytest.raises(ValueError):
        vector_index.build(frame(spark, [[1, 2], [1, 2, 3]]), str(tmp_path / "mixed"))


def test_no_vectors(spark, tmp_path):
    found = vector_index.build(frame(spark, [None, [0, 0]]), str(tmp_path / "none"))
    assert found.search([1.0, 0.0]).count() == 0


def test_index_is_read_back(spark, index, tmp_path):
    vectors = clustered(300, dimensions=8)
    path = str(tmp_path / "again")
    built = vector_index.build(frame(spark, vectors).withColumn("extra", F.lit(1)), path, cells=6)
    again = vector_index.load(spark, path)
    q = vectors[7].tolist()
    assert built.search(q, exact=True).collect() == again.search(q, exact=True).collect()


def test_search_among_some_keys(spark, index):
    vectors, found = index
    some = [f"k{i:06d}" for i in range(0, 20_000, 7)]
    keys = spark.createDataFrame([(k,) for k in some], "key string")
    q = vectors[3].astype("float64")
    ranked = [k for k in true_nearest(vectors, q, len(vectors))[0] if int(k[1:]) % 7 == 0][:5]
    for exact in (True, False):
        assert [r.key for r in found.among(keys).search(q.tolist(), k=5, exact=exact).collect()] == ranked
