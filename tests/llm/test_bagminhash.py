"""Signatures against exact similarity, and classes against brute force."""

import collections
import random

import numpy as np
import pytest

from orderlake.llm import bagminhash
from orderlake.llm.queries import QUERIES


def bag(text):
    w = (text or "").encode().split()
    return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def jaccard(a, b):
    shared = sum((a & b).values())
    return shared / (sum(a.values()) + sum(b.values()) - shared)


def brute(rows, threshold=0.8):
    """Class (least key) and size by comparing everything with everything that shares a shingle."""
    texts = {t or "" for _, t in rows}
    bags = {t: bag(t) for t in texts}
    parent = {t: t for t in texts}

    def find(t):
        while parent[t] != t:
            t = parent[t]
        return t

    holders = collections.defaultdict(list)
    for t, b in bags.items():
        for s in b:
            holders[s].append(t)
    seen = set()
    for held in holders.values():
        for i, a in enumerate(held):
            for b in held[i + 1 :]:
                if (a, b) not in seen:
                    seen |= {(a, b), (b, a)}
                    if jaccard(bags[a], bags[b]) >= threshold:
                        parent[find(a)] = find(b)
    classes = collections.defaultdict(list)
    for k, t in rows:
        classes[find(t or "")].append(k)
    return sorted((k, min(c), len(c)) for c in classes.values() for k in c)


def words(rng, n):
    return [rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()) + str(rng.randrange(60)) for _ in range(n)]


def edited(rng, w, share):
    return [x if rng.random() > share else f"e{rng.randrange(10**6)}" for x in w]


def test_signatures_estimate_weighted_similarity():
    rng = random.Random(1)
    base = words(rng, 300)
    a = " ".join(base + base[:100] * 3).encode()
    for share in (0.01, 0.03, 0.1):
        b = " ".join(edited(rng, base, share) + base[:100] * 2).encode()
        s = bagminhash.signatures(*bagminhash.bags([a, b]), 2, 4000)
        assert abs((s[0] == s[1]).mean() - jaccard(bag(a.decode()), bag(b.decode()))) < 0.04


def test_signature_does_not_depend_on_the_texts_beside_it():
    texts = [b"one", b"one two three four five six", b"x " * 5000, b""]
    together = bagminhash.signatures(*bagminhash.bags(texts), 4, 64)
    for i, t in enumerate(texts):
        assert (bagminhash.signatures(*bagminhash.bags([t]), 1, 64)[0] == together[i]).all()
    assert np.isinf(together[3]).all()


def test_exact_similarity_of_a_block():
    rng = random.Random(2)
    base = words(rng, 120)
    texts = [" ".join(edited(rng, base, rng.choice([0, 0.01, 0.05]))) for _ in range(40)] + ["a b c", "a b c d e a b c d e a b c d e"]
    near = bagminhash.alike([t.encode() for t in texts], 0.8, columns=64)
    want = [[jaccard(bag(a), bag(b)) >= 0.8 for b in texts] for a in texts]
    assert near.tolist() == want


@pytest.mark.parametrize("block", [400, 7])
def test_classes_against_brute_force(spark, block):
    rng = random.Random(3)
    rows = [(1000, None), (1001, ""), (1002, "  "), (1003, "one two"), (1004, "one two"), (1005, "word " * 3000)]
    key = 0
    for size in (1, 2, 5, 40):
        base = words(rng, rng.randrange(40, 150))
        for _ in range(size):
            rows.append((key, " ".join(edited(rng, base, rng.choice([0, 0.01, 0.02, 0.04, 0.1])))))
            key += 1
    rows += rows[8:10]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in bagminhash.near_duplicates(docs, block=block).collect())
    assert got == brute(rows)
    kept = bagminhash.keep_one(docs.selectExpr("doc_id", "text", "1 AS key_", "2 AS root"), block=block)
    assert kept.columns == ["doc_id", "text", "key_", "root"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c, _ in brute(rows)})


@pytest.mark.parametrize("seen", [1 << 18, 0])
def test_a_task_makes_the_bands_of_a_text_once(spark, monkeypatch, seen):
    monkeypatch.setattr(bagminhash, "SEEN", seen)
    rng = random.Random(7)
    texts = [" ".join(words(rng, 60)) for _ in range(3)]
    texts.append(texts[0] + " and")
    rows = [(i, texts[i % 4]) for i in range(40)] + [(40, None), (41, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    signed = bagminhash._signed(bagminhash._slim(docs, "doc_id", "text")).collect()
    assert len(signed) == 42
    assert sum(len(r.bands) for r in signed) == 4 * bagminhash.BANDS
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = sorted(tuple(r) for r in bagminhash.near_duplicates(docs).collect())
        # With batches of three rows the task forgets, or all rows of a batch are copies.
        forgetful = bagminhash._signed(bagminhash._slim(docs, "doc_id", "text")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute(rows)
    assert (sum(len(r.bands) for r in forgetful) > 4 * bagminhash.BANDS) == (seen == 0)


def test_empty_table_and_null_keys(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bagminhash.near_duplicates(empty).count() == 0
    assert bagminhash.keep_one(empty).count() == 0
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (5, "a b c d e f"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(str(x) for x in r) for r in bagminhash.near_duplicates(docs).collect())
    assert got == [("5", "5", "3"), ("None", "5", "3"), ("None", "5", "3"), ("None", "None", "1")]
    assert sorted(str(r.doc_id) for r in bagminhash.keep_one(docs).collect()) == ["5", "None"]


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in QUERIES["op9_bagminhash"](spark, sf).collect())
    assert got == brute(rows)
    assert any(n > 1 for _, _, n in got)
