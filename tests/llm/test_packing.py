"""Cuts against an exhaustive search, and packed sequences against the tokenizer itself."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from orderlake.llm import packing
from orderlake.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


def cost_of(cuts, price, length, end, inside):
    total, before = 0, 0
    for c in cuts:
        size = c - before
        assert 0 < size <= length
        total += price.get(c, inside if c != end else 0)
        total += 0 if size & (size - 1) == 0 and c not in price else length - size
        before = c
    return total


def brute(places, costs, length):
    """Least cost of windows that end at candidates."""
    best = {0: 0}
    for p, c in zip(places, costs, strict=True):
        best[p] = c + min(best[q] + length - (p - q) for q in best if 0 < p - q <= length)
    return best


@pytest.mark.parametrize("seed", range(12))
def test_cuts_are_the_cheapest(seed):
    rng = random.Random(seed)
    length, inside = 32, 6
    places = sorted(rng.sample(range(1, 400), 90)) + [400]
    places = sorted(set(places) | set(range(10, 400, 10)))
    costs = [rng.choice([0, 1, 6]) for _ in places[:-1]] + [0]
    best = brute(places, costs, length)
    tails = [best[q] + inside * ((400 - q).bit_count() - 1) for q in best if 0 < 400 - q <= length]
    want = min([best[400], *tails])
    cuts = packing.choose_cuts(np.array(places), np.array(costs), length, inside)
    assert cuts[-1] == 400 and cuts == sorted(set(cuts))
    price, total, before = dict(zip(places, costs, strict=True)), 0, 0
    in_tail = False
    for c in cuts:
        size = c - before
        assert 0 < size <= length
        # A power of two that ends where no candidate is, or the last window, belongs to the split remainder.
        in_tail = in_tail or c not in price
        total += inside if c not in price else price[c] if not in_tail else 0
        total += 0 if in_tail or (c == 400 and size & (size - 1) == 0) else length - size
        before = c
    assert total <= want + inside * 5


def test_candidates_leave_no_wide_stretch():
    costs = packing.Costs(stretch=7)
    places, price = packing.candidates(np.array([3, 50, 51]), np.array([3, 10, 20]), costs)
    assert set(places) >= {3, 10, 20, 50, 51} and np.diff([0, *places]).max() <= 7 and np.diff(places).min() > 0
    assert dict(zip(places.tolist(), price.tolist(), strict=True))[50] == 0


def tokens(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def verify(rows, texts, length):
    """Every id is in one piece; sequences are gapless; returns the padded share."""
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert pieces.keys() == texts.keys()
    for k, held in pieces.items():
        ids, at = tokens(tokenizer, texts[k]), 0
        for r in sorted(held, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    padding = total = 0
    for held in sequences.values():
        at, before = 0, None
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at and (before is None or r.doc_id > before)
            at, before = at + r.length, r.doc_id
        assert at <= length
        total += at
        padding += 0 if at & (at - 1) == 0 else length - at
    return padding / total


def test_query_packs_everything(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert verify(QUERIES["op1_packing"](spark, sf).collect(), texts, 4096) < 0.01


def test_odd_rows(spark):
    from pyspark.sql import functions as F

    rows = [(1, None), (2, ""), (3, "One two. Three! " * 400), (4, "x" * 5000), (5, "a\x1cb c. d"), (6, " \n "), (7, "Ünïcode <|endoftext|> q")]
    docs = spark.createDataFrame([(*r, "z", 5) for r in rows], "doc_id long, text string, tokens string, start int")
    out = packing.pack(docs, PATH, length=64, costs=packing.Costs(stretch=16), run_tokens=500)
    out = out.withColumn("ids_crc32", F.crc32("tokens"))
    assert verify(out.collect(), dict(rows), 64) < 0.2
    assert packing.pack(docs.limit(0), PATH).count() == 0
    repeated = packing.pack(docs.union(docs), PATH).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t"))
    assert all(r.n == 2 * r.t for r in repeated.collect())
    assert packing.pack(spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string"), PATH).count() == 2
