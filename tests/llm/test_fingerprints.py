"""Sketches against exact sets, and the query against a plain version."""

import base64
import hashlib
import random

import numpy as np
import pytest

from orderlake.llm import fingerprints as fp
from orderlake.llm.queries import QUERIES
from orderlake.llm.shingles import shingle_hashes


def exact(a, b):
    sets = [set(shingle_hashes([t.encode()])[0].tolist()) for t in (a, b)]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1]) if sets[0] | sets[1] else 1.0


def words(rng, n, kinds=500):
    return " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))


def test_shingles_are_those_of_the_words():
    rng = random.Random(1)
    texts = ["", " \n", "one", "a b c d", "a b c d e", "a b c d e f", words(rng, 300), " lead\ttrail \r\n", "ä ö\vü ß é è", "x" * 50000 + " y"]
    hashes, bounds = shingle_hashes([t.encode() for t in texts])
    names = {}
    for i, t in enumerate(texts):
        w = t.encode().split()
        want = [tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))] if w else []
        got = hashes[bounds[i] : bounds[i + 1]].tolist()
        assert len(got) == len(want)
        assert all(names.setdefault(s, h) == h for s, h in zip(want, got, strict=True))
    assert len(set(names.values())) == len(names)


def test_estimates():
    rng = random.Random(2)
    base = words(rng, 6000, 5000).split()
    part = base[:3000]
    a, b = " ".join(base), " ".join(part)
    sa, sb = fp.sketches([a.encode(), b.encode()])
    assert len(sa) == len(sb) == fp.K and (np.diff(sa.astype(object)) > 0).all()
    assert abs(fp.resemblance(sa, sb) - exact(a, b)) < 0.1
    assert fp.containment(sb, sa) > 0.85 and abs(fp.containment(sa, sb) - 0.5) < 0.12
    assert abs(fp.distinct_count(sa) / len(set(shingle_hashes([a.encode()])[0].tolist())) - 1) < 0.2
    assert (fp.from_text(fp.as_text(sa)) == sa).all()
    small = fp.sketches([" ".join(base[:100]).encode(), " ".join(base[50:120]).encode(), b""])
    assert fp.resemblance(small[0], small[1]) == exact(" ".join(base[:100]), " ".join(base[50:120]))
    assert fp.resemblance(small[2], small[2]) == 1.0 and fp.resemblance(small[0], small[2]) == 0.0
    assert fp.distinct_count(small[0]) == 96 and fp.containment(small[2], small[0]) == 1.0


def test_repeats_do_not_shorten_a_sketch():
    rng = random.Random(3)
    t = ("the same five words again " * 3000 + words(rng, 400, 4000)).encode()
    want = np.unique(shingle_hashes([t])[0])[: fp.K]
    assert (fp.sketches([t])[0] == want).all()


def test_merged_sketches(spark):
    rng = random.Random(4)
    rows = [(i % 3, words(rng, rng.choice([0, 3, 200, 2000]), 3000)) for i in range(30)] + [(None, None), (7, "")]
    sketched = fp.fingerprint(spark.createDataFrame(rows, "part long, text string"))
    got = {r.part: np.frombuffer(bytes(r.fingerprint), "<u8") for r in fp.merge_fingerprints(sketched, ["part"]).collect()}
    for part in (0, 1, 2):
        each = [t.encode() for p, t in rows if p == part]
        want = np.unique(np.concatenate([shingle_hashes([t])[0] for t in each]))[: fp.K]
        assert (got[part] == want).all()
        assert (fp.merged(fp.sketches(each)) == want).all()


def brute(rows):
    """Rows (key, text) without ties."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for (k, t), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        t, following = t or "", following or ""
        n = len(t) // 3
        edited = t[: len(t) - n] + following[:n]
        a, e, f = fp.sketches([t.encode(), edited.encode(), following.encode()])
        near = (fp.resemblance(a, e), fp.resemblance(a, f))
        out[k] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), fp.as_text(a), fp.as_text(e), *near)
    return out


@pytest.mark.parametrize("n", [1, 2, 9, 400])
def test_neighbours(spark, n):
    rng = random.Random(n)
    rows = [(3 * i + rng.randrange(3), rng.choice([None, "", "é" * 10, words(rng, 40), words(rng, 900)])) for i in range(n)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, fingerprint string, part int")
    got = {r.doc_id: tuple(r)[1:] for r in fp.compare_neighbours(docs).collect()}
    assert got == brute(rows)


def test_ties_nulls_and_the_empty_table(spark):
    rows = [(5, "a b"), (5, "a b"), (5, "c d"), (None, "e f"), (None, None), (1, "g h i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(str(r.doc_id) for r in fp.compare_neighbours(docs).collect()) == sorted(str(k) for k, _ in rows)
    nulls = spark.createDataFrame([(None, "a b c"), (None, "d e f")], "doc_id long, text string")
    assert fp.compare_neighbours(nulls).count() == 2
    assert fp.compare_neighbours(docs.limit(0)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op7_fingerprints"](spark, sf).collect()}
    assert got == brute(rows)
    errors = [abs(near - exact(t, u)) for (k, t), (_, u) in zip(rows[1:200], rows[:199], strict=True) for near in [got[k][5]]]
    assert max(errors) < 0.15 and len(base64.b64decode(got[rows[0][0]][2])) % 8 == 0
