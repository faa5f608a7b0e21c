"""The search against SQL and against scoring every pair; bounds that discard most pairs."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from oracle_check import compare, connect

from orderlake.llm import dual_tree
from orderlake.llm.queries import ORACLE_SQL, QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k):
    held = [(key, Counter(terms(t))) for key, t in docs]
    held = [(key, c) for key, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for key, c in held:
            m = 100 - 25 + (25 * sum(c.values()) * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c
            )
            if score:
                found.append((-score, key is not None, key))
        out += [(item, i + 1, key, -s) for i, (s, _, key) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_the_query_is_its_sql(spark, sf):
    path = f"/root/testdata/{sf}"
    assert compare(QUERIES["op13_dual_tree"](spark, path), connect(path), ORACLE_SQL["op13_dual_tree"]) == []


def random_texts(seed, n, kinds=80, longest=60):
    rng = random.Random(seed)
    names = [f"w{i}" if i % 3 else f"Ŵ{i}É" for i in range(kinds)]
    return [" ".join(rng.choices(names, [1 / (i + 1) for i in range(kinds)], k=rng.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(2))
def test_random_tables_are_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(dual_tree, "BLOCK_ITEMS", 40)
    monkeypatch.setattr(dual_tree, "CELLS", 4000)
    docs = list(enumerate(random_texts(seed, 400)))
    docs += [(1000 + i, docs[7][1]) for i in range(60)] + [(5, "w1 w2"), (5, "w1 w2"), (None, docs[7][1]), (2000, None), (2001, "--"), (2002, "w1 " * 50_000)]
    items = list(enumerate(random_texts(seed + 50, 70, longest=15))) + [(3, "w1 w1 nothing"), (None, "W7 w7"), (300, None), (301, "absent"), (302, docs[7][1])]
    d = spark.createDataFrame([(k, t, 1) for k, t in docs], "doc_id long, text string, score long").repartition(4)
    i = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, rank int")
    found = got(dual_tree.search(d, i, k=5))
    assert [x for x in found if x[0] != 3] == [x for x in plain(docs, items, 5) if x[0] != 3]
    # Two items have the key 3; each has its own five rows.
    assert [x for x in found if x[0] == 3] == [x for x in plain(docs, items, 5) if x[0] == 3]


def test_nothing_to_search(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a"), (2, "")], "item_id long, text string")
    assert got(dual_tree.search(docs.limit(0), items)) == [] == got(dual_tree.search(docs, items.limit(0))) == got(dual_tree.search(docs.where("doc_id = 2"), items))
    assert dual_tree.search(docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    assert got(dual_tree.search(docs, items)) == plain([(1, "a b"), (2, None)], [(1, "a"), (2, "")], 20)


def test_most_pairs_are_discarded(spark):
    """Documents of forty subjects: an item about one of them has twenty good ones, and the other subjects go by bounds."""
    rng = random.Random(4)
    docs = [(i, " ".join(f"s{i % 40}w{rng.randrange(60)}" for _ in range(40))) for i in range(8000)]
    items = [(j, " ".join(f"s{j % 40}w{rng.randrange(60)}" for _ in range(12))) for j in range(80)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    i = spark.createDataFrame(items, "item_id long, text string")
    pairs, scored = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    assert got(dual_tree.search(d, i, counters=(pairs, scored))) == plain(docs, items, 20)
    assert pairs.value == 8000 * 80 and scored.value < 0.1 * pairs.value


def test_bounds_hold():
    rng = np.random.default_rng(3)
    held = [np.unique(rng.integers(0, 30, 6)) for _ in range(40)]
    rows = dual_tree.Rows.of([(ids, rng.integers(0, 9, len(ids))) for ids in held])
    table = rng.integers(0, 50, (64, 30))
    leaves, best = rows.maxima(dual_tree._bounds(40, 8)), np.maximum.reduceat(table, np.arange(0, 64, 16), axis=0)
    scores = rows.times(table)
    assert (leaves.times(best) >= np.maximum.reduceat(np.maximum.reduceat(scores, np.arange(0, 64, 16), axis=0), np.arange(0, 40, 8), axis=1)).all()
    dense = np.zeros((40, 30), np.int64)
    for i in range(40):
        dense[i, rows.ids[rows.starts[i] : rows.starts[i + 1]]] = rows.values[rows.starts[i] : rows.starts[i + 1]]
    assert (scores == table @ dense.T).all()


def test_lengths_beyond_64_bits():
    corpus = dual_tree.Corpus(3 * 10**10, 10**13)
    n = np.array([10**9, 5])
    assert corpus.lengths(n).tolist() == [75 + 25 * x * 3 * 10**10 // 10**13 for x in n.tolist()]
