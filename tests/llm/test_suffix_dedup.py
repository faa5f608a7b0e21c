"""Repeated strings against a brute-force search over all windows."""

import collections
import hashlib
import random

import pytest

from orderlake.llm import suffix_dedup
from orderlake.llm.queries import QUERIES


def brute(texts, size):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[s : s + size] for b in raw for s in range(len(b) - size + 1))
    out = []
    for b in raw:
        covered = bytearray(len(b))
        for s in range(len(b) - size + 1):
            if seen[b[s : s + size]] > 1:
                covered[s : s + size] = b"\1" * size
        spans, at = [], 0
        while (at := covered.find(1, at)) >= 0:
            end = covered.find(0, at)
            end = len(b) if end < 0 else end
            spans.append((at, end))
            at = end
        out.append((len(b), spans, bytes(c for c, x in zip(b, covered, strict=True) if not x)))
    return out


def check(spark, texts, size):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs, min_bytes=size).collect()}
    for i, (n, spans, kept) in enumerate(brute(texts, size)):
        assert (got[i].n_bytes, [tuple(s) for s in got[i].spans], bytes(got[i].kept)) == (n, spans, kept), i


def noise(rng, n):
    return "".join(rng.choice("abcdé \n") for _ in range(n))


def test_planted_passages(spark):
    rng = random.Random(4)
    shared = [noise(rng, n) for n in (39, 40, 41, 60, 150, 400)]
    texts = [None, "", "short", "x" * 39, "x" * 40]
    for _ in range(60):
        parts = [noise(rng, rng.randrange(0, 120)) for _ in range(3)] + rng.sample(shared, 2)
        rng.shuffle(parts)
        texts.append("".join(parts))
    texts += texts[10:14] + [t[:50] + "#" + t[50:] for t in texts[14:30]]
    check(spark, texts, 40)


def test_periodic_and_long_texts(spark, monkeypatch):
    rng = random.Random(5)
    base = noise(rng, 3000)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 512)
    check(spark, ["a" * 500, "ab" * 300, "abc" * 100 + "d" + "abc" * 100, base, base[500:1200], base[:900] + "!" + base[901:]], 100)


def test_common_passage_in_many_texts(spark):
    rng = random.Random(6)
    passage = noise(rng, 130)
    check(spark, [noise(rng, rng.randrange(20, 90)) + passage + noise(rng, 50) for _ in range(120)], 100)


def test_empty_table_and_clashing_columns(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, kept string, k1 int, carried string")
    out = suffix_dedup.remove_repeats(docs)
    assert out.columns == ["doc_id", "text", "k1", "carried", "n_bytes", "spans", "kept"]
    assert out.count() == 0


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = {
        d.doc_id: (n, sum(e - a for a, e in spans), len(spans), hashlib.sha256(kept).hexdigest())
        for d, (n, spans, kept) in zip(docs, brute([d.text for d in docs], 400), strict=True)
    }
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op4_suffix_dedup"](spark, sf).collect()}
    assert got == want
    assert sum(v[1] for v in want.values()) > 0


def test_too_short_strings_are_refused(spark):
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(spark.createDataFrame([("a",)], "text string"), min_bytes=4)
