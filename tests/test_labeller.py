"""A labeller that learns from stars: against plain Python, and on reviews that no word was learned from."""

import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from orderlake import settings
from orderlake.plans import labeller

SCHEMA = "review_id long, rating long, comment string"


def some_reviews(seed, n, noise=0.25):
    """Reviews whose words lean to their stars, about topics that have words of their own."""
    rng, out = random.Random(seed), []
    topics = {"delivery": ["rider", "late", "road", "wait"], "pricing": ["price", "bill", "coupon"], "service": ["staff", "phone", "polite"]}
    for i in range(n):
        rating = rng.choice([1, 2, 3, 4, 5, 5])
        kind = "good" if (rating >= 4) != (rng.random() < noise) else "bad"
        lean = [kind + rng.choice("abcdefghijkl") for _ in range(3)]
        about = rng.sample(topics[rng.choice(list(topics))], 2)
        common = ["Common" + rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)]
        out.append((i, rating, ", ".join(rng.sample(lean + about + common, 11))))
    return out


def words(text):
    return set(re.findall(labeller.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))


def plain_weights(rows, strength=100.0):
    up, down = Counter(), Counter()
    for _, rating, text in rows:
        (up if rating >= 4 else down if rating <= 2 else Counter()).update(words(text))
    n_up, n_down, out = sum(up.values()), sum(down.values()), {}
    for w in up | down:
        prior = strength * (up[w] + down[w]) / (n_up + n_down)
        u, d = up[w] + prior, down[w] + prior
        weight = math.log(u / (n_up + strength - u)) - math.log(d / (n_down + strength - d))
        if abs(weight) >= 1.96 * math.sqrt(1 / u + 1 / d):
            out[w] = weight
    return out


def test_weights_scores_and_topics_are_those_of_plain_python(spark):
    rows = some_reviews(1, 600) + [(9000, None, "gooda rider"), (9001, 5, None), (9002, 1, "12 !"), (9003, 2, "Bada bada ünknown")]
    reviews = spark.createDataFrame(rows, SCHEMA)
    want = plain_weights([r for r in rows if r[1]])
    got = {r.word: r.weight for r in labeller.word_weights(reviews).collect()}
    assert got.keys() == want.keys() and all(abs(got[w] - want[w]) < 1e-9 for w in want) and len(want) > 10
    scores = {r.review_id: (r.raw, r.key_issue) for r in labeller.raw_scores(reviews, labeller.word_weights(reviews)).collect()}
    for i, _, text in rows:
        hit = words(text) & want.keys()
        assert (i in scores) == bool(hit)
        if hit:
            low = min((want[w], w) for w in hit)
            assert abs(scores[i][0] - sum(want[w] for w in hit)) < 1e-9 and scores[i][1] == (low[1] if low[0] < 0 else None)
    n = Counter(w for r in rows for w in words(r[2]))
    of = {t: [words(r[2]) for r in rows if words(r[2]) & set(a)] for t, a in labeller.ANCHORS.items()}
    affinity = {
        (w, t): math.log(both * len(rows) / (n[w] * len(texts)))
        for t, texts in of.items() for w, both in Counter(x for ws in texts for x in ws).items() if both >= 5
    }
    topics = {r.review_id: r.topic for r in labeller.topics_of(reviews, labeller.topic_weights(reviews)).collect()}
    for i, _, text in rows:
        sums = {t: sum(max(affinity.get((w, t), 0), 0) for w in words(text)) for t in settings.TOPICS}
        best = max(settings.TOPICS, key=lambda t: (round(sums[t], 9), -settings.TOPICS.index(t)))
        assert topics.get(i) == (best if sums[best] > 0 else None)


def test_held_out_stars_are_told_better_than_by_the_majority(spark):
    reviews = spark.createDataFrame(some_reviews(2, 3000), SCHEMA)
    learned = labeller.learn(reviews)
    right, majority = labeller.held_out_accuracy(learned, reviews)
    assert right > majority + 0.08 and right > 0.7
    assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(learned.steps[:-1], learned.steps[1:], strict=True))
    labels = learned.labels(reviews).join(reviews.drop("comment"), "review_id").collect()
    assert len(labels) == 3000 and {r.topic for r in labels} <= set(settings.TOPICS)
    assert all(-1 <= r.sentiment_score <= 1 and r.model == "learned-1" for r in labels)
    assert all((r.key_issue is None) for r in labels if r.sentiment_label != "negative")
    # Calibrated: of the reviews with a score around s, (s + 1) / 2 are content.
    fold = [r for r in labels if r.rating != 3 and zlib.crc32(str(r.review_id).encode()) % 4 == 0]
    for low, high in ((-1, -0.2), (0.2, 1)):
        here = [r for r in fold if low <= r.sentiment_score <= high]
        assert abs(sum(r.rating >= 4 for r in here) / len(here) - sum((r.sentiment_score + 1) / 2 for r in here) / len(here)) < 0.05


def test_topics_grow_from_their_anchors(spark):
    reviews = spark.createDataFrame(some_reviews(3, 1500), SCHEMA)
    found = {(r.word, r.topic) for r in labeller.topic_weights(reviews).where("affinity > 0.5").collect()}
    assert {("road", "delivery"), ("coupon", "pricing"), ("phone", "service")} <= found
    assert not any(w in ("road", "wait") and t != "delivery" for w, t in found)


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([(1, 3, "x"), (2, None, "y"), (3, 5, None)], SCHEMA)
    labels = labeller.learn(none).labels(none).collect()
    assert len(labels) == 3 and {(r.topic, r.key_issue) for r in labels} == {("other", None)}
    assert labeller.learn(none.limit(0)).labels(none.limit(0)).count() == 0


@pytest.mark.parametrize("points", [[(0, 1, 4), (1, 0, 4), (2, 3, 4)], [(0, 0, 1)], [(i, i % 3, 4) for i in range(9)]])
def test_monotone(points):
    steps = labeller.monotone(points)
    assert all(a[1] < b[1] for a, b in zip(steps[:-1], steps[1:], strict=True))
    assert steps[0][1] <= sum(h for _, h, _ in points) / sum(n for _, _, n in points) <= steps[-1][1]


def test_a_run_can_use_it(spark, tmp_path):
    from orderlake.plans import daily

    w = daily.Warehouse(spark, str(tmp_path))
    rows = spark.createDataFrame(some_reviews(4, 300), SCHEMA)
    spare = [F.lit(1).cast("long").alias(c) for c in ("order_id", "customer_id", "restaurant_id")]
    latest = rows.select("review_id", *spare, "rating", "comment", F.md5("comment").alias("comment_hash"), F.current_date().alias("review_date"),
                         F.lit("f").alias("_source_file"), F.current_timestamp().alias("_loaded_at"))
    latest.write.parquet(w.location("staging", "latest_reviews"))
    spark.createDataFrame([(1, "Pune")], "restaurant_id long, city string").write.parquet(w.location("marts", "dim_restaurants"))
    daily.enrich(w, daily.LEARNED, "", F.lit("2026-09-04").cast("timestamp"), None)
    assert w.labels.count() == 300 and w.labels.where("sentiment_label = 'negative'").count() > 30


def test_words_are_what_the_pattern_finds(spark):
    texts = ["Éa Bc bC x\tbc", "日本 a_b a1b 'Tis", "", None, "  ", "ÀÈ\x00Z z ~é~é"]
    rows = spark.createDataFrame(list(enumerate(texts)), "review_id long, comment string")
    got = {r.review_id: r.words for r in labeller.with_words(rows, "review_id").collect()}
    for i, t in enumerate(texts):
        assert sorted(got[i]) == sorted(words(t))


def test_one_pass_over_the_words_learns_all(spark):
    rows = some_reviews(3, 400) + [(9000, None, "gooda rider"), (9001, 5, None)]
    reviews = labeller.with_words(spark.createDataFrame(rows, SCHEMA), "review_id", "rating").localCheckpoint()
    counts = labeller.word_counts(reviews)
    by_word = counts._jdf.queryExecution().optimizedPlan().toString()
    assert by_word.count("Generate explode") == 1
    values = labeller.word_values(counts)
    judged = labeller.judged(reviews, values)
    assert judged._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") == 2
    got = {r.review_id: (r.raw and round(r.raw, 9), r.key_issue, r.topic) for r in judged.collect()}
    scores = {r.review_id: (r.raw, r.key_issue) for r in labeller.raw_scores(reviews, labeller.word_weights(reviews)).collect()}
    topics = {r.review_id: r.topic for r in labeller.topics_of(reviews, labeller.topic_weights(reviews)).collect()}
    assert got == {i: (scores[i][0] and round(scores[i][0], 9) if i in scores else None, scores.get(i, (0, None))[1], topics.get(i)) for i in scores.keys() | topics.keys()}
    assert len(scores) > 300 and len(topics) > 300
