"""Counts and votes against plain Python, estimation against a plain loop, and the verdicts against labels."""

import math
import re
from collections import Counter

import numpy as np

from orderlake.llm import weak_rules as wr
from orderlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen, dup = set(), 0
    for line in lines:
        dup += line in seen
        seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def plain_votes(text):
    words = WORD.findall(text)
    n, chars, symbols, dup, repeated = plain_counts(text)
    if not n:
        return (0,) * len(wr.RULES)
    joined = "".join(words)
    letter = [bool(re.search(r"[A-Za-z\x80-\U0010ffff]", w)) for w in words]
    plain, lines = re.findall("[A-Za-z]", text), [x for x in text.split("\n") if WORD.search(x)]
    stops = sum(re.sub(r"[\"')\]}]+\Z", "", w)[-1:] in tuple(".!?") for w in words)
    marks = set("!?#*$%&=~_^+")
    some = float("nan") if n < 10 else 1.0
    stats = [
        chars / n,
        symbols / n,
        sum(c.isupper() for c in plain) / len(plain) if len(plain) >= 20 else math.nan,
        sum(c in "0123456789" for c in text) / chars,
        letter.count(False) / n,
        some * (n / stops if stops else math.inf),
        sum(len(w.encode()) > 1 and w[-1] in marks and w[-2:-1] in marks for w in words) / n,
        dup / len(lines) if len(lines) >= 3 else math.nan,
        some * repeated / n,
        len(re.findall(r"[A-Za-z\x80-\U0010ffff]", joined)) / chars,
        some * (sum(len(w) <= 3 for w, a in zip(words, letter, strict=True) if a) / sum(letter) if any(letter) else math.nan),
    ]
    good = [x >= r.good[0] and x <= r.good[1] for x, r in zip(stats, wr.RULES, strict=True)]
    bad = [x < r.fair[0] or x > r.fair[1] for x, r in zip(stats, wr.RULES, strict=True)]
    return tuple(1 if g else -1 if b else 0 for g, b in zip(good, bad, strict=True))


def plain_model(patterns, rounds=200):
    """Expectation-maximisation, one document pattern after the other."""
    seen = {v: n for v, n in patterns.items() if any(v)}
    post = {v: 0.5 + 0.5 * sum(v) / sum(map(abs, v)) for v in seen}
    k, before = len(wr.RULES), -math.inf
    for _ in range(rounds):
        total = sum(seen.values())
        share = (sum(n * post[v] for v, n in seen.items()) + 1) / (total + 2)
        right = []
        for j in range(k):
            g = [sum(n * post[v] for v, n in seen.items() if v[j] == s) for s in (1, -1)]
            b = [sum(n * (1 - post[v]) for v, n in seen.items() if v[j] == s) for s in (1, -1)]
            clip = lambda x: min(max(x, 0.55), 0.999)
            right.append((clip((g[0] + 1) / (sum(g) + 2)), clip((b[1] + 1) / (sum(b) + 2))))

        def posterior(v, share=share, right=right):
            good = share * math.prod(a if x == 1 else 1 - a for x, (a, _) in zip(v, right, strict=True) if x)
            bad = (1 - share) * math.prod(b if x == -1 else 1 - b for x, (_, b) in zip(v, right, strict=True) if x)
            return good / (good + bad)

        post = {v: posterior(v) for v in seen}
        moved = sum(n * post[v] for v, n in seen.items())
        if abs(moved - before) <= 1e-10 * total:
            break
        before = moved
    return posterior


ODD = [None, "", " \n\t", "one", "a b a b a b a b", "x\x1cy z\x85w", "é ü ß " * 40, "same line here\n" * 30, "1 2 3 | | |", "w" * 200_000, "()[]{}", "\n\n\n", "A!! B?? C##\r\nD"]


def test_counts_and_votes_are_those_of_plain_python(spark):
    texts = [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()] + ODD
    counts, stats = wr.statistics([(t or "").encode() for t in texts])
    assert counts.tolist() == [list(plain_counts(t or "")) for t in texts]
    assert list(map(tuple, wr.votes(stats).tolist())) == [plain_votes(t or "") for t in texts]


def test_the_query_is_brute_force(spark):
    rows = QUERIES["op11_weak_rules"](spark, SF).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    cast = {d: plain_votes(t) for d, t in texts.items()}
    posterior = plain_model(Counter(cast.values()))
    for r in rows:
        n, chars, symbols, dup, repeated = plain_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeated)
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n)
        assert abs(r.posterior - posterior(cast[r.doc_id])) < 2e-6
        assert r.kept == (not r.base_failed and posterior(cast[r.doc_id]) >= 0.5)


def test_verdicts_agree_with_labels(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = QUERIES["op11_weak_rules"](spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("NOT base_failed").collect()
    assert sum(r.quality == 0 for r in rows) > 200
    assert np.mean([r.kept for r in rows if r.quality == 1]) > 0.99
    assert np.mean([r.kept for r in rows if r.quality == 0]) < 0.05


def test_accuracies_are_recovered():
    rng = np.random.default_rng(8)
    good = rng.random(40_000) < 0.8
    right = rng.uniform(0.7, 0.95, (2, 8))
    hit = rng.random((40_000, 8)) < np.where(good[:, None], right[0], right[1])
    cast = np.where(hit == good[:, None], 1, -1) * (rng.random((40_000, 8)) < 0.7)
    kinds, n = np.unique(cast.astype(np.int8), axis=0, return_counts=True)
    model = wr.estimate(kinds, n)
    assert abs(model.share - 0.8) < 0.02
    assert np.abs(model.right_good - right[0]).max() < 0.03 and np.abs(model.right_bad - right[1]).max() < 0.06
    assert np.mean((model.posterior(cast) >= 0.5) == good) > 0.93


def test_odd_rows(spark):
    rows = [(i, t, 0.5, "mine") for i, t in enumerate(ODD)] + [(0, None, 0.1, "again"), (None, "one", None, None)]
    out = wr.judge(spark.createDataFrame(rows, "doc_id long, text string, posterior double, Kept string"))
    assert out.columns == ["doc_id", "text", *wr.COUNTS, "votes", "posterior", "base_failed", "kept"]
    got = out.collect()
    assert len(got) == len(rows) and not any(r.kept for r in got if r.n_words < 50)
    assert len({r.posterior for r in got if not (r.text or "").strip()}) == 1
    assert wr.judge(spark.createDataFrame([], "text string")).count() == 0
    silent = wr.judge(spark.createDataFrame([(None,), ("",)], "text string")).collect()
    assert [r.posterior for r in silent] == [0.5, 0.5] and not any(r.kept for r in silent)
