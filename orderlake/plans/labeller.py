"""Labels that are learned from the reviews' own stars, for a platform without a labelling model.

* A word's weight is its log-odds between reviews of many and of few stars, with the word's share in all reviews as prior, so
  that a rare word needs proof; words whose weight is within chance (``least_z`` standard errors) have none.
* A review's raw score is the sum over its different words. Star signs per bin of raw scores, made monotone, turn it into the
  probability that its author was content, and that into a score from -1 to 1 and a label.
* Topics grow from a few anchor words: a word belongs to a topic as far as it stands in reviews with the topic's anchors more often than
  chance (pointwise mutual information). The topic with the greatest sum over the review's words is its topic.
* The issue of a negative review is its word with the lowest weight.

Words are taken from each review once, into a written table. All that is learned of them is counted in one pass, combined before it is
shuffled; it is a table with a row per word, joined like any other and once (nothing is broadcast by hand). Only the bins, at most ``BINS``, reach the driver.

Defined cases: a review without words, or with unknown ones only, is as good as the average, and its topic is "other". A null rating
and three stars teach nothing of sentiment. Equal topics: the first of ``settings.TOPICS``; equal words: the first in the alphabet.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake import settings
from orderlake.session import shared_dir
from orderlake.sources import tables

WORD = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Words that name their topic.
ANCHORS = {
    "food quality": ("food", "taste", "dish"),
    "delivery": ("delivery", "rider", "late"),
    "pricing": ("price", "money", "cost"),
    "service": ("service", "staff", "support"),
    "packaging": ("packaging", "package", "box"),
}
#: Bins of raw scores, each of this width, around 0.
BINS, WIDTH = 80, 0.25
LEARNED_MODEL = "learned-1"


#: Bytes of kept letters and of all characters outside ASCII stay, A-Z become a-z, others become blanks.
_LETTERS = bytes(b if b >= 0x80 or chr(b) in string.ascii_letters else 0x20 for b in range(256)).lower()


def with_words(reviews: DataFrame, *columns: str) -> DataFrame:
    """Some columns of the reviews, and the different ``words`` of their comments, of which only A-Z are lower-cased. Written, that
    table spares each reader the extraction."""
    if "words" in reviews.columns:
        return reviews.select(*columns, "words")
    rows = reviews.select(*columns, F.col("comment").cast("binary").alias("words"))
    schema = T.StructType([*rows.schema[: len(columns)], T.StructField("words", T.ArrayType(T.StringType()))])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Every byte of a character outside ASCII is at least 0x80, so runs of bytes are the runs that ``WORD`` finds.
            words = [dict.fromkeys(t.translate(_LETTERS).split()) if t else () for t in batch.column(len(columns)).to_pylist()]
            offsets = pa.array(accumulate(map(len, words), initial=0), pa.int32())
            flat = pa.array(chain.from_iterable(words), pa.binary()).view(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.ListArray.from_arrays(offsets, flat)], names=schema.names)

    return rows.mapInArrow(each, schema)


def _exploded(reviews: DataFrame, *columns: str) -> DataFrame:
    return with_words(reviews, *columns).select(*columns, F.explode("words").alias("word"))


def _up() -> Column:
    return F.col("rating") >= 4


def _down() -> Column:
    return F.col("rating") <= 2


def _about(named: tuple[str, ...]) -> Column:
    """Whether a review has one of a topic's anchors."""
    return F.coalesce(F.arrays_overlap("words", F.array(*map(F.lit, named))), F.lit(False))


def word_counts(reviews: DataFrame, anchors: dict[str, tuple[str, ...]] = ANCHORS, learned_from: Column | None = None) -> DataFrame:
    """One row per word, from one pass: its reviews (``n``), those of them with many and few stars (``up``, ``down``; only of reviews
    ``learned_from``), and those of each topic (``both``, in the anchors' order); and the same numbers of all reviews (``all_up``,
    ``all_down`` of words, ``all_n``, ``all_both`` of reviews)."""
    chosen = F.lit(True) if learned_from is None else F.coalesce(learned_from, F.lit(False))
    seen = with_words(reviews, "rating", *([] if learned_from is None else ["review_id"]))
    seen = seen.select("words", (_up() & chosen).alias("up"), (_down() & chosen).alias("down"), *(_about(a).alias(f"about{i}") for i, a in enumerate(anchors.values())))
    about = [f"about{i}" for i in range(len(anchors))]
    sizes = F.coalesce(F.array_size("words"), F.lit(0))

    def total(of: Column) -> Column:
        return seen.agg(of.alias("n")).scalar()

    totals = {
        "all_up": total(F.sum(F.when(F.col("up"), sizes))),
        "all_down": total(F.sum(F.when(F.col("down"), sizes))),
        "all_n": total(F.count(F.lit(1))),
        "all_both": F.array(*(total(F.count_if(F.col(c))) for c in about)),
    }
    pairs = seen.select("up", "down", *about, F.explode("words").alias("word"))
    counts = pairs.groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("up").alias("up"), F.count_if("down").alias("down"), *(F.count_if(c).alias(c) for c in about)
    )
    return counts.select("word", "n", "up", "down", F.array(*about).alias("both")).withColumns(totals)


def _weight(strength: float, least_z: float) -> Column:
    """A word's weight from its counts, null where it has none."""
    prior = F.lit(strength) * (F.col("up") + F.col("down")) / F.nullif(F.coalesce("all_up", F.lit(0)) + F.coalesce("all_down", F.lit(0)), F.lit(0))
    up, down = (F.nullif(F.col(c) + prior, F.lit(0.0)) for c in ("up", "down"))

    def odds(n: Column, total: str) -> Column:
        return F.log(n / (F.coalesce(total, F.lit(0)) + strength - n))

    weight = odds(up, "all_up") - odds(down, "all_down")
    return F.when((F.col("up") + F.col("down") > 0) & (F.abs(weight) >= least_z * F.sqrt(1 / up + 1 / down)), weight)


def _affinity(i: int, least_together: int) -> Column:
    """A word's affinity to the topic of this number from its counts, null where it has none."""
    both, of_topic = F.col("both")[i], F.nullif(F.col("all_both")[i], F.lit(0))
    affinity = F.log(both * F.col("all_n") / (F.col("n") * of_topic.cast("double")))
    return F.when((both >= least_together) & (affinity > 0), affinity)


def word_weights(reviews: DataFrame, strength: float = 100.0, least_z: float = 1.96) -> DataFrame:
    """(word, weight) of the words that tell content reviews (four stars and more) from others (two and fewer)."""
    starred = reviews.where(_up() | _down())
    return word_counts(starred, {}).select("word", _weight(strength, least_z).alias("weight")).where("weight IS NOT NULL")


def topic_weights(reviews: DataFrame, anchors: dict[str, tuple[str, ...]] = ANCHORS, least_together: int = 5) -> DataFrame:
    """(word, topic, affinity): how much more often than by chance a word stands with a topic's anchors, in logs and above 0."""
    each = [F.struct(F.lit(t).alias("topic"), _affinity(i, least_together).alias("affinity")) for i, t in enumerate(anchors)]
    return word_counts(reviews, anchors).select("word", F.inline(F.array(*each))).where("affinity IS NOT NULL")


def word_values(counts: DataFrame, anchors: dict[str, tuple[str, ...]] = ANCHORS, strength: float = 100.0, least_z: float = 1.96, least_together: int = 5) -> DataFrame:
    """(word, weight, affinity0, affinity1, ...), by the numbers of the anchors' topics: of the words that say anything."""
    values = {"weight": _weight(strength, least_z)} | {f"affinity{i}": _affinity(i, least_together) for i in range(len(anchors))}
    return counts.select("word", *(v.alias(name) for name, v in values.items())).where(F.coalesce(*values).isNotNull())


def _worst() -> Column:
    return F.min(F.when(F.col("weight") < 0, F.struct("weight", "word"))).alias("worst")


def _best(topics: list[tuple[str, Column]]) -> Column:
    """The topic with the greatest sum; sums are rounded, so that topics with the same words are equal whatever the order of adding."""
    order = {t: i for i, t in enumerate(settings.TOPICS)}
    ranked = [F.when(a.isNotNull(), F.struct(F.round(a, 9).alias("a"), F.lit(-order.get(t, -1)).alias("p"), F.lit(t).alias("topic"))) for t, a in topics]
    return F.array_max(F.array(*ranked))["topic"]


def judged(reviews: DataFrame, values: DataFrame, anchors: dict[str, tuple[str, ...]] = ANCHORS) -> DataFrame:
    """(review_id, raw, key_issue, topic) of the reviews with words that say anything, as ``raw_scores`` and ``topics_of`` have them; the
    words meet their values once."""
    names = [f"affinity{i}" for i in range(len(anchors))]
    sums = _exploded(reviews, "review_id").join(values, "word").groupBy("review_id").agg(F.sum("weight").alias("raw"), _worst(), *(F.sum(c).alias(c) for c in names))
    best = _best([(t, F.col(c)) for t, c in zip(anchors, names, strict=True)])
    return sums.select("review_id", "raw", F.col("worst.word").alias("key_issue"), best.alias("topic"))


def raw_scores(reviews: DataFrame, weights: DataFrame) -> DataFrame:
    """(review_id, raw, key_issue) of the reviews with words that have weights; the issue is the word with the lowest weight below 0."""
    hits = _exploded(reviews, "review_id").join(weights, "word").groupBy("review_id").agg(F.sum("weight").alias("raw"), _worst())
    return hits.select("review_id", "raw", F.col("worst.word").alias("key_issue"))


def topics_of(reviews: DataFrame, affinities: DataFrame) -> DataFrame:
    """(review_id, topic) of the reviews with words that belong to a topic."""
    sums = _exploded(reviews, "review_id").join(affinities, "word").groupBy("review_id", "topic").agg(F.sum("affinity").alias("affinity"))
    place = F.array_position(F.array(*map(F.lit, settings.TOPICS)), F.col("topic"))
    # Sums are rounded, so that topics with the same words are equal whatever the order of adding.
    best = F.max_by("topic", F.struct(F.round("affinity", 9), -place))
    return sums.groupBy("review_id").agg(best.alias("topic"))


def monotone(points: list[tuple[float, float, float]]) -> list[tuple[float, float]]:
    """Shares that don't fall, from (place, hits, number) in ascending order: pools of neighbours, as (place of the middle, share)."""
    pools: list[list[float]] = []
    for place, hits, n in points:
        pools.append([place * n, hits, n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return [(p / n, hits / n) for p, hits, n in pools]


@dataclass(frozen=True)
class Labeller:
    """What was learned: a table of words, the topics its affinities are to, and the steps of the calibration."""

    values: DataFrame
    anchors: dict[str, tuple[str, ...]]
    steps: list[tuple[float, float]]

    @property
    def weights(self) -> DataFrame:
        return self.values.where("weight IS NOT NULL").select("word", "weight")

    def probability(self, raw: Column) -> Column:
        """Of a content author: linear between the steps, level outside."""
        out = F.lit(self.steps[0][1])
        for (x0, y0), (x1, y1) in zip(self.steps[:-1], self.steps[1:], strict=True):
            out = F.when(raw >= x0, F.lit(y0) + (raw - x0) * ((y1 - y0) / (x1 - x0))).otherwise(out)
        return F.when(raw >= self.steps[-1][0], F.lit(self.steps[-1][1])).otherwise(out)

    def labels(self, reviews: DataFrame, model: str = LEARNED_MODEL, unsure: float = 0.2) -> DataFrame:
        """Labels like those of a model; scores within ``unsure`` of 0 are neutral."""
        scored = reviews.select("review_id").join(judged(reviews, self.values, self.anchors), "review_id", "left")
        score = 2.0 * self.probability(F.coalesce("raw", F.lit(0.0))) - 1.0
        label = F.when(score < -unsure, "negative").when(score > unsure, "positive").otherwise("neutral")
        return scored.select(
            "review_id",
            label.alias("sentiment_label"),
            F.round(score, 3).alias("sentiment_score"),
            F.coalesce("topic", F.lit("other")).alias("topic"),
            F.when(label == "negative", F.col("key_issue")).alias("key_issue"),
            F.lit(model).alias("model"),
        )


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = shared_dir(df.sparkSession, name)
    tables.full_refresh(df, path)
    return df.sparkSession.read.parquet(path)


def _held_out() -> Column:
    return F.crc32(F.col("review_id").cast("string")) % 4 == 0


def learn(reviews: DataFrame, anchors: dict[str, tuple[str, ...]] = ANCHORS) -> Labeller:
    """Learn from reviews with stars (``review_id``, ``rating``, ``comment``): words from three quarters of them, the calibration from the
    quarter that the words weren't learned from."""
    reviews = _stored(with_words(reviews, "review_id", "rating"), "review_words")
    values = _stored(word_values(word_counts(reviews, anchors, ~_held_out()), anchors), "word_values")
    learned = Labeller(values, anchors, [(0.0, 0.5)])
    starred = reviews.where(_held_out() & (_up() | _down()))
    scored = starred.select("review_id", _up().cast("int").alias("up")).join(raw_scores(starred, learned.weights), "review_id", "left")
    place = F.floor(F.coalesce("raw", F.lit(0.0)) / WIDTH)
    place = F.least(F.greatest(place, F.lit(-BINS // 2)), F.lit(BINS // 2 - 1))
    bins = scored.groupBy(place.alias("bin")).agg(F.sum("up").alias("up"), F.count(F.lit(1)).alias("n"))
    points = sorted(((r.bin + 0.5) * WIDTH, float(r.up), float(r.n)) for r in bins.collect())  # at most BINS rows
    return replace(learned, steps=monotone(points) or learned.steps)


def held_out_accuracy(labeller: Labeller, reviews: DataFrame) -> tuple[float, float]:
    """How often the sign of the raw score is that of the stars, in the quarter that no word was learned from; and the share of the more
    frequent sign there, which a labeller has to beat."""
    starred = reviews.where(_held_out() & ((F.col("rating") >= 4) | (F.col("rating") <= 2)))
    up = F.col("rating") >= 4
    scored = starred.select("review_id", up.alias("up")).join(raw_scores(starred, labeller.weights), "review_id", "left")
    says_up = labeller.probability(F.coalesce("raw", F.lit(0.0))) >= 0.5
    right, share = scored.agg(F.avg((says_up == F.col("up")).cast("double")), F.avg(F.col("up").cast("double"))).head()
    return (right or 0.0), max(share or 0.0, 1.0 - (share or 0.0))
