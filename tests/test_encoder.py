"""A fitted encoder: its basis against a whole decomposition, and its neighbours against those of hashed counts."""

import random

import numpy as np
from pyspark.sql import functions as F

from orderlake.plans import encoder as enc
from orderlake.plans import reviews


def some_texts(seed, n):
    """Texts of forty subjects in a common padding of frequent words, and a near copy of each with half of its own words changed."""
    rng, texts, copies = random.Random(seed), [], []
    frequent = ["and", "the", "was", "very", "it", "is", "of", "we"]

    def word(subject):
        return f"s{chr(97 + subject % 26)}{chr(97 + subject // 26)}" + "".join(rng.choice("mnop") for _ in range(3))

    for i in range(n):
        own = [word(i % 40) for _ in range(8)]
        pad = rng.choices(frequent, k=20)
        texts.append(" ".join(rng.sample(own + pad, 28)))
        changed = [w if rng.random() < 0.5 else word(i % 40) for w in own]
        copies.append(" ".join(changed + rng.choices(frequent, k=20)))
    return texts, copies


def agreement(a, b):
    """How often a text's nearest copy is its own."""
    return float(np.mean((a @ b.T).argmax(1) == np.arange(len(a))))


def test_near_copies_are_found_more_often_than_with_hashed_counts(spark):
    texts, copies = some_texts(1, 400)
    rows = [(f"t{i}", t) for i, t in enumerate(texts)] + [(f"c{i}", t) for i, t in enumerate(copies)]
    frame = spark.createDataFrame(rows, "comment_hash string, comment string").repartition(3)
    fitted = enc.fit(frame, dimensions=64)
    found = {r.comment_hash: np.array(r.embedding) for r in reviews.encoded_vectors(frame, fitted, enc.FITTED_MODEL).collect()}
    counted = {r.comment_hash: np.array(r.embedding) for r in reviews.hashed_vectors(frame).collect()}

    def of(vectors):
        return agreement(*(np.array([vectors[f"{k}{i}"] for i in range(400)]) for k in "tc"))

    assert of(found) > of(counted) + 0.1 and of(found) > 0.5
    assert all(abs(np.linalg.norm(v) - 1) < 1e-5 for v in found.values())
    assert reviews.vector_lengths(reviews.encoded_vectors(frame, fitted, "m")) == {"m": 64}


def test_the_basis_spans_the_greatest_directions(spark):
    texts, _ = some_texts(2, 300)
    frame = spark.createDataFrame([(t,) for t in texts], "comment string").repartition(4)
    fitted = enc.fit(frame, buckets=512, dimensions=24, passes=12)
    a = np.zeros((len(texts), 512))
    for i, t in enumerate(texts):
        at, values = fitted.sparse(t)
        a[i, at] = values
    kept, best = np.linalg.norm(a @ fitted.basis) ** 2, np.linalg.norm(np.linalg.svd(a, compute_uv=False)[:24]) ** 2
    assert 0.97 * best <= kept <= best * (1 + 1e-9)
    assert np.abs(fitted.basis.T @ fitted.basis - np.eye(24)).max() < 1e-9
    df = np.array([sum(bool(fitted.sparse(t)[0].tolist().count(b)) for t in texts) for b in range(512)])
    assert np.allclose(fitted.weights, np.where(df > 0, np.log(301 / (df + 1)), 0))


def test_parts_are_added_up_alike_however_the_texts_are_dealt(spark):
    texts, _ = some_texts(3, 100)
    frame = spark.createDataFrame([(t,) for t in texts], "comment string")
    one, many = (enc.fit(frame.repartition(n), buckets=256, dimensions=8) for n in (1, 7))
    assert np.allclose(one.basis @ one.basis.T, many.basis @ many.basis.T, atol=1e-6)


def test_odd_texts(spark):
    frame = spark.createDataFrame([(None,), ("",), ("12 !",), ("ünder Ünder",)], "comment string")
    for some in (frame, frame.limit(0), frame.where("comment IS NULL")):
        fitted = enc.fit(some, buckets=64, dimensions=4)
        found = fitted([None, "", "7", "unknown words"])
        assert found.shape == (4, 4) and np.isfinite(found).all() and not found[:3].any()
    assert frame.select(F.count(F.lit(1))).head()[0] == 4
