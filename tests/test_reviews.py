import json
import math

import numpy as np
import pytest
from helpers import day, rows, ts
from pyspark.sql import functions as F

from orderlake import settings
from orderlake.plans import marts, reviews

SEARCH = (
    "review_id bigint, review_date date, city string, rating bigint, comment string, comment_hash string, "
    "restaurant_id bigint, restaurant_name string, cuisine string, restaurant_rating_at_review decimal(3,1), "
    "cost_for_two_at_review bigint, order_id bigint, order_date date, sales_amount bigint, delivery_time_min bigint, "
    "payment_method string, sentiment_label string, topic string, key_issue string"
)


@pytest.fixture(scope="module")
def mart(spark):
    from decimal import Decimal

    def review(i, date, city, rating, text, restaurant_rating, topic=None):
        rated = None if restaurant_rating is None else Decimal(restaurant_rating)
        return (i, day(date), city, rating, text, f"h-{text}", 7, "R", "Pizzas", rated, 300, None, None, None, None, None, None, topic, None)

    data = [
        review(1, "2026-09-01", "Delhi", 1, "late", "3.0", "delivery"),
        review(2, "2026-09-02", "delhi", 2, "late", "4.5"),
        review(3, "2026-09-03", "Pune", 3, "late", "3.0"),
        review(4, "2026-09-04", "Pune", 5, "great", None),
        review(5, "2026-09-05", "Delhi", 4, "hot", "3.5"),
        review(6, "2026-09-05", "Delhi", 4, "cold", "3.5"),
        review(7, "2026-09-05", None, 4, "zero", "3.5"),
        review(8, "2026-09-05", "Goa", 4, "unknown", "3.5"),
    ]
    return spark.createDataFrame(data, SEARCH)


@pytest.fixture(scope="module")
def vectors(spark):
    data = [("late", [1.0, 0.0]), ("great", [0.0, 1.0]), ("hot", [1.0, 1.0]), ("cold", [2.0, 2.0]), ("zero", [0.0, 0.0])]
    return spark.createDataFrame([(f"h-{t}", t, v) for t, v in data], "comment_hash string, comment string, embedding array<float>")


def ids(df):
    return [r[0] for r in rows(df, "review_id")]


@pytest.mark.parametrize(
    "args, expected",
    [
        ({}, [1, 2, 3, 4, 5, 6, 7, 8]),
        ({"city": "DELHI"}, [1, 2, 5, 6]),
        ({"city": ""}, [1, 2, 3, 4, 5, 6, 7, 8]),
        ({"date_from": "2026-09-02", "date_to": day("2026-09-03")}, [2, 3]),
        ({"sentiment": "negative"}, [1, 2]),
        ({"sentiment": "neutral"}, [3]),
        ({"sentiment": "positive", "max_restaurant_rating": 3.5}, [5, 6, 7, 8]),
        ({"topic": "delivery"}, [1]),
        ({"max_restaurant_rating": 0}, []),
        ({"city": "Delhi'; drop table x; --"}, []),
    ],
)
def test_filters(mart, args, expected):
    assert ids(reviews.review_filter(mart, reviews.ReviewQuery(**args))) == expected


def test_arguments():
    args = reviews.ReviewQuery(query="  ", date_from="2026-09-06", date_to="2026-09-06", city="Delhi")
    assert args.query == settings.DEFAULT_QUESTION
    assert args.restrictions == {"city": "Delhi", "date_from": day("2026-09-06"), "date_to": day("2026-09-06")}
    assert reviews.ReviewQuery().restrictions == {}
    with pytest.raises(TypeError):
        reviews.ReviewQuery(town="Delhi")


@pytest.mark.parametrize(
    "bad",
    [{"sentiment": "angry"}, {"topic": "weather"}, {"k": 50}, {"k": 0}, {"max_restaurant_rating": 9}, {"max_restaurant_rating": -1}, {"date_from": "soon"}],
)
def test_bad_arguments(bad):
    with pytest.raises(ValueError):
        reviews.ReviewQuery(query="x", **bad)


def test_search_ranks_texts_and_shows_newest_examples(mart, vectors):
    found = reviews.review_search(mart, vectors, [1.0, 0.0], reviews.ReviewQuery(query="late", k=4))
    got = [(r.comment, r.n_reviews, r.similarity, r.review_id) for r in found.collect()]
    # Equal similarity: the lower hash first. A zero vector has no similarity and comes last.
    assert got == [("late", 3, 1.0, 3), ("late", 3, 1.0, 2), ("cold", 1, 0.707, 6), ("hot", 1, 0.707, 5), ("great", 1, 0.0, 4)]
    grouped = reviews.search_results(found).collect()
    assert [(r.text, r.reviews, len(r.examples)) for r in grouped] == [("late", 3, 2), ("cold", 1, 1), ("hot", 1, 1), ("great", 1, 1)]
    assert [e.review_id for e in grouped[0].examples] == [3, 2]


def test_search_respects_filters_in_counts(mart, vectors):
    found = reviews.review_search(mart, vectors, [1.0, 0.0], reviews.ReviewQuery(query="late", city="Delhi", sentiment="negative"))
    assert [(r.comment, r.n_reviews, r.review_id) for r in found.collect()] == [("late", 2, 2), ("late", 2, 1)]


@pytest.mark.parametrize(
    "args, count, note",
    [
        ({"city": "Delhi"}, 4, None),
        ({"city": "Nowhere"}, 0, reviews.NOTHING_MATCHES),
        ({"city": "Goa"}, 1, reviews.NOTHING_ENCODED),
    ],
)
def test_search_summary(mart, vectors, args, count, note):
    row = reviews.search_summary(mart, vectors, reviews.ReviewQuery(**args)).head()
    assert (row.matching_reviews, row.note) == (count, note)


REVIEWS = "review_id bigint, comment string"


def test_rule_labels(spark):
    texts = [
        (1, "Two hours DELAYED, and nobody called."),
        (2, "Such a tasty dosa, and so punctual!"),
        (3, "An ordinary lunch."),
        (4, "Every box was dented or dripping."),
        (5, "A bargain, but the man at the door was unfriendly."),
        (6, "Slowly baked, the kindest crispness."),
    ]
    got = reviews.rule_labels(spark.createDataFrame(texts, REVIEWS))
    assert rows(got, "review_id", "sentiment_label", "sentiment_score", "topic", "key_issue") == [
        (1, "negative", -1.0, "delivery", "delayed"),
        (2, "positive", 1.0, "food quality", None),
        (3, "neutral", 0.0, "other", None),
        (4, "negative", -1.0, "packaging", "dented"),
        (5, "neutral", 0.0, "service", "unfriendly"),
        (6, "neutral", 0.0, "other", None),
    ]


def answer(label="negative", score=-0.5, topic="delivery", issue="late"):
    return json.dumps({"sentiment_label": label, "sentiment_score": score, "topic": topic, "key_issue": issue})


def test_model_answers_are_checked(spark):
    replies = {
        "good": answer(),
        "no issue": answer(issue=None),
        "text null": answer(issue="null"),
        "not json": "sorry",
        "bad topic": answer(topic="weather"),
        "bad label": answer(label="angry"),
        "bad score": answer(score=3),
        "long": answer(issue="one two three four five six seven"),
        "missing": json.dumps({"sentiment_label": "neutral"}),
    }

    def labeller(comment):
        if comment == "fails":
            raise TimeoutError("no reply")
        return replies[comment]

    todo = spark.createDataFrame([(i, c) for i, c in enumerate([*replies, "fails"])], REVIEWS)
    checked = reviews.checked_answers(reviews.model_answers(todo, labeller), "m")
    assert rows(reviews.good_answers(checked), "review_id", "sentiment_score", "key_issue", "model") == [
        (0, -0.5, "late", "m"),
        (1, -0.5, None, "m"),
        (2, -0.5, None, "m"),
    ]
    assert rows(reviews.quarantine(checked), "review_id", "problem") == [
        (3, "not readable"),
        (4, "unknown topic"),
        (5, "unknown sentiment"),
        (6, "score out of range"),
        (7, "issue too long"),
        (8, "not readable"),
        (9, "TimeoutError: no reply"),
    ]


def test_reviews_to_enrich(spark):
    todo = spark.createDataFrame([(i, "x") for i in range(9)], REVIEWS)
    labels = spark.createDataFrame([(0,), (3,), (3,)], "review_id bigint")
    assert ids(reviews.reviews_to_enrich(todo, labels)) == [1, 2, 4, 5, 6, 7, 8]
    assert ids(reviews.reviews_to_enrich(todo, labels, 3)) == [1, 2, 4]
    tried = spark.createDataFrame([(1,), (2,), (2,), (4,), (8,)], "review_id bigint")
    assert ids(reviews.reviews_to_enrich(todo, labels, 4, tried)) == [1, 5, 6, 7]


def test_newest_label_wins_and_insights_count_all(spark):
    labels = spark.createDataFrame(
        [
            (1, "negative", -0.5, "delivery", "late", ts("2026-09-01")),
            (1, "neutral", 0.0, "delivery", None, ts("2026-09-02")),
            (1, "neutral", 0.2, "delivery", None, ts("2026-09-01")),
            (2, "negative", None, "delivery", "x", ts("2026-09-01")),
        ],
        "review_id bigint, sentiment_label string, sentiment_score double, topic string, key_issue string, enrichment_at timestamp",
    )
    assert rows(marts.latest_enrichment(labels), "review_id", "sentiment_label") == [(1, "neutral"), (2, "negative")]
    stars = spark.createDataFrame([(1, "Pune", 2), (2, "Pune", 5)], "review_id bigint, city string, rating bigint")
    assert rows(marts.mart_review_insights(stars, labels)) == [
        ("Pune", "delivery", "negative", 2, -0.5, 3.5, 2),
        ("Pune", "delivery", "neutral", 2, 0.1, 2.0, 0),
    ]


def test_texts_to_embed(spark):
    texts = spark.createDataFrame([("a", "A"), ("a", "A"), ("b", "B"), ("c", "C"), ("c", "C")], "comment_hash string, comment string")
    known = spark.createDataFrame([("b",)], "comment_hash string")
    assert rows(reviews.texts_to_embed(texts, known)) == [("a", "A"), ("c", "C")]
    assert rows(reviews.texts_to_embed(texts, None)) == [("a", "A"), ("b", "B"), ("c", "C")]
    assert rows(reviews.texts_to_embed(texts, known, 1)) == [("a", "A")]


def test_hashed_vectors_hold_word_counts(spark):
    texts = {"1": "late late cold", "2": "Cold LATE late", "3": "great food", "4": ""}
    got = {
        r.comment_hash: np.array(r.embedding)
        for r in reviews.hashed_vectors(spark.createDataFrame(list(texts.items()), "comment_hash string, comment string")).collect()
    }
    assert all(len(v) == 256 for v in got.values())
    np.testing.assert_array_equal(got["1"], got["2"])
    assert sorted(v for v in got["1"] if v) == pytest.approx([1 / math.sqrt(5), 2 / math.sqrt(5)])
    assert np.linalg.norm(got["3"]) == pytest.approx(1) and got["1"] @ got["3"] == pytest.approx(0)


def test_hashed_vectors_move_no_row_and_blanks_are_those_of_ascii(spark):
    texts = [("1", "a\u00a0b \t\x0b\x0cÉ\r\né", ), ("2", "a\u00a0b é é"), ("3", None), ("4", " \n"), ("5", "x " * 3000)]
    vectors = reviews.hashed_vectors(spark.createDataFrame(texts, "comment_hash string, comment string").repartition(2, "comment"), dimensions=16)
    assert vectors._jdf.queryExecution().sparkPlan().toString().count("Exchange") <= 1  # the one asked for above
    assert "Aggregate" not in vectors._jdf.queryExecution().sparkPlan().toString()
    got = {r.comment_hash: (r.comment, r.embedding) for r in vectors.collect()}
    assert {k: c for k, (c, _) in got.items()} == dict(texts) and all(len(v) == 16 for _, v in got.values())
    assert got["1"][1] == got["2"][1] and not any(got["3"][1]) and not any(got["4"][1]) and sum(got["5"][1]) == 1


def test_encoder_gets_batches_and_is_retried(spark, tmp_path):
    log = tmp_path / "calls"

    def encoder(texts):
        with open(log, "a") as out:
            out.write(f"{len(texts)}\n")
        if len(open(log).readlines()) == 1:
            raise ConnectionError("try again")
        return [[3.0 * len(t), 4.0 * len(t)] for t in texts]

    texts = spark.createDataFrame([(str(i), "x" * (i + 1)) for i in range(10)], "comment_hash string, comment string").coalesce(1)
    got = reviews.encoded_vectors(texts, encoder, "m", batch_size=4, pause=0.01).collect()
    assert [int(n) for n in open(log)] == [4, 4, 4, 2]
    assert sorted(r.comment_hash for r in got) == [str(i) for i in range(10)]
    assert all(r.embedding == pytest.approx([0.6, 0.8]) and r.model == "m" for r in got)


def test_encoder_that_keeps_failing_fails_the_job(spark):
    def encoder(texts):
        raise ConnectionError("down")

    texts = spark.createDataFrame([("1", "x")], "comment_hash string, comment string")
    with pytest.raises(Exception, match="down"):
        reviews.encoded_vectors(texts, encoder, "m", pause=0.0).collect()


def test_question_vector_uses_the_same_method(spark):
    vector = reviews.question_vector(spark, "late delivery", reviews.hashed_vectors)
    assert len(vector) == 256 and np.linalg.norm(vector) == pytest.approx(1)


def test_hot_text_is_counted_before_the_shuffle(spark, mart, vectors):
    found = reviews.review_search(mart, vectors, F.array(F.lit(1.0), F.lit(0.0)), reviews.ReviewQuery(k=1))
    assert found.head().n_reviews == 3


def test_texts_are_ranked_by_the_unrounded_score(spark, mart):
    near = [("late", [0.9001, math.sqrt(1 - 0.9001**2)]), ("great", [0.9004, math.sqrt(1 - 0.9004**2)])]
    vectors = spark.createDataFrame([(f"h-{t}", t, v) for t, v in near], "comment_hash string, comment string, embedding array<double>")
    found = reviews.search_results(reviews.review_search(mart, vectors, [1.0, 0.0], reviews.ReviewQuery()))
    assert [(r.text, r.similarity) for r in found.collect()] == [("great", 0.9), ("late", 0.9)]


def test_vectors_of_other_models_are_left_out(spark, mart):
    data = [("h-late", "late", [1.0, 0.0], "a"), ("h-great", "great", [1.0, 0.0], "b")]
    vectors = spark.createDataFrame(data, "comment_hash string, comment string, embedding array<float>, model string")
    found = reviews.review_search(mart, vectors, [1.0, 0.0], reviews.ReviewQuery(), model="b")
    assert {r.comment for r in found.collect()} == {"great"}
    assert reviews.search_summary(mart, vectors, reviews.ReviewQuery(), model="c").head().note == reviews.NOTHING_ENCODED


def test_vectors_of_one_model_have_one_length(spark):
    vectors = spark.createDataFrame([("a", [1.0]), ("b", [1.0, 2.0]), ("b", [2.0, 2.0])], "model string, embedding array<float>")
    assert reviews.vector_lengths(vectors) == {"a": 1, "b": 2}
    with pytest.raises(ValueError, match="differ"):
        reviews.vector_lengths(vectors.withColumn("model", F.lit("m")))


def test_a_search_that_fails_says_so(mart, vectors):
    def broken(texts):
        raise ConnectionError("encoder is away")

    found = reviews.search_reviews(mart, vectors, broken, query="late")
    assert "encoder is away" in found.error and found.matching_reviews == 8 and found.results == []


def test_search_takes_texts_from_beside_the_rows(spark, mart):
    """Rows without comments, and a table of texts, give what rows with comments give."""
    hashes = mart.select("comment_hash").distinct()
    vectors = hashes.select("comment_hash", F.array(F.lit(1.0), F.crc32("comment_hash") % 7 + 0.5).alias("embedding"))
    args = reviews.ReviewQuery(query="late", k=3)
    whole = reviews.review_search(mart, vectors, [1.0, 0.5], args)
    apart = reviews.review_search(mart.drop("comment"), vectors, [1.0, 0.5], args, texts=mart.select("comment_hash", "comment"))
    assert whole.columns == apart.columns and rows(whole) == rows(apart) and whole.count() > 0


def test_vectors_alone_move_no_text(spark):
    """Neither the mart's rows nor the vectors take a text through a join or an aggregate."""
    from orderlake.sources import sample_tables as sample

    vectors = sample.review_embeddings(lambda name: sample.table(spark, "/root/testdata/sf0.001", name)).select("comment_hash", "embedding")
    plan = vectors._jdf.queryExecution().optimizedPlan().toString()
    assert "min_by(text" not in plan and "min_by(struct" not in plan
