"""Quality rules by weak supervision: rules vote or abstain, their accuracies are estimated, and a posterior decides.

Each rule looks at one statistic of a text and votes good (1) or bad (-1), or abstains (0) between two bounds and where it has
nothing to look at. Nobody says which votes are right: expectation-maximisation finds, for the two unseen kinds
of documents, their shares and how often each rule that votes is right about either kind. A rule that contradicts
the others so gets little weight, and no single rule can reject a document.

Votes are counted per pattern by Spark over all documents. Eleven rules have at most 3**11 = 177,147 patterns, so that the driver
estimates on a table of bounded size, and the posteriors go back as a table of the same size.

The base checks of ``judge`` (too few words, too much repetition) stay as they are: what fails them is never kept.

Defined cases: a null text has no words, all rules abstain, and its posterior is the share of good documents; so it is for
every text without words. Without any vote in the table that share is 0.5. Every row counts, repeated ones each time; equal
texts get equal results. A posterior of exactly ``threshold`` is kept. An empty table gives no rows; a text of any length is read
whole, in one task. Input columns are carried through; one named like a result column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm import terms
from orderlake.llm.common import written

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RESULT = (*COUNTS, "votes", "posterior", "base_failed", "kept")


@dataclass(frozen=True)
class Rule:
    """Good where the statistic is within ``good``, bad where it is outside ``fair``."""

    name: str
    good: tuple[float, float]
    fair: tuple[float, float]


RULES = (
    Rule("word length", (3.0, 9.0), (2.0, 14.0)),
    Rule("symbols per word", (0.0, 0.02), (0.0, 0.1)),
    Rule("share of capitals among A-Z and a-z", (0.0, 0.12), (0.0, 0.3)),
    Rule("share of digits", (0.0, 0.03), (0.0, 0.15)),
    Rule("share of words without a letter", (0.0, 0.03), (0.0, 0.15)),
    Rule("words per end of a sentence", (3.0, 60.0), (1.5, 200.0)),
    Rule("share of words with repeated marks at the end", (0.0, 0.01), (0.0, 0.05)),
    Rule("share of repeated lines", (0.0, 0.1), (0.0, 0.3)),
    Rule("share of words in repeated windows", (0.0, 0.15), (0.0, 0.4)),
    Rule("share of letters among the characters of words", (0.93, 1.0), (0.9, 1.0)),
    Rule("share of short words among those with a letter", (0.15, 0.75), (0.08, 0.9)),
)

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BLANKS = bytes(range(9, 14)) + b" "


def _table(characters: bytes) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[list(characters)] = 1
    return out


_BYTE = np.arange(256)
_LEADS = ((_BYTE < 0x80) | (_BYTE > 0xBF)).astype(np.int64)  # one for each code point
_SYMBOL, _MARK = _table(b"#*$%&|<>"), _table(b"!?#*$%&=~_^+")
_DIGIT, _UPPER = _table(b"0123456789"), _table(bytes(range(65, 91)))
_LOWER = _table(bytes(range(97, 123)))
_LETTER = ((_UPPER + _LOWER) | (_BYTE >= 0x80)).astype(np.int64)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values between neighbouring bounds."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[bounds])


def _repeat_words(codes: np.ndarray, kinds: int, counts: np.ndarray, size: int = 3) -> np.ndarray:
    """Words in windows of ``size`` words that the text has twice or more."""
    n = len(codes)
    covered = np.zeros(n + 1, np.int64)
    if n >= size:
        window = codes.astype(np.int64)
        for i in range(1, size):
            # Numbers stay below n, so that no product gets too large.
            _, window = np.unique(window[: n - i] * max(kinds, 1) + codes[i:], return_inverse=True)
        owner = np.repeat(np.arange(len(counts)), counts)
        inside = owner[: n - size + 1] == owner[size - 1 :]
        places = np.flatnonzero(inside)
        _, at, seen = np.unique(owner[places] * (n + 1) + window[places], return_inverse=True, return_counts=True)
        twice = places[seen[at] > 1]
        np.add.at(covered, twice, 1)
        np.add.at(covered, np.minimum(twice + size, n), -1)
    return _sums(np.cumsum(covered[:n]) > 0, np.concatenate([[0], np.cumsum(counts)]))


def _repeated_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them that are equal to an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(_BLANKS)]
    return len(lines), len(lines) - len(set(lines))


def statistics(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The counts (one row per text, as in COUNTS) and the statistics that the rules look at (NaN: nothing to look at)."""
    kinds, codes, n_words = terms.numbered([t.split() for t in texts])
    raw = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])

    def of_text(table: np.ndarray) -> np.ndarray:
        return _sums(table[raw], bounds)

    words = kinds.to_pylist()
    n = len(words)
    sizes = np.fromiter(map(len, words), np.int64, n)
    letters = np.frombuffer(b"".join(words), np.uint8)
    at = np.concatenate([[0], np.cumsum(sizes)])
    with_letter = _sums(_LETTER[letters], at) > 0
    short = with_letter & (_sums(_LEADS[letters], at) <= 3)
    last = letters[at[1:] - 1] if n else np.zeros(0, np.uint8)
    before = letters[np.maximum(at[1:] - 2, at[:-1])] if n else last
    marked = (sizes > 1) & (_MARK[last] > 0) & (_MARK[before] > 0)
    closing = np.fromiter((w.rstrip(b"\"')]}").endswith((b".", b"!", b"?")) for w in words), bool, n)
    by_word = np.concatenate([[0], np.cumsum(n_words)])

    def of_words(values: np.ndarray) -> np.ndarray:
        return _sums(values[codes].astype(np.int64), by_word)

    word_chars, n_symbols = of_text(_LEADS * ~_BLANK), of_text(_SYMBOL)
    pairs = [_repeated_lines(t) for t in texts]
    n_lines, n_dup_lines = (np.array([p[i] for p in pairs], np.int64) for i in (0, 1))
    n_repeat_words = _repeat_words(codes, n, n_words)
    plain = of_text(_UPPER) + of_text(_LOWER)
    with np.errstate(divide="ignore", invalid="ignore"):
        stats = [
            word_chars / n_words,
            n_symbols / n_words,
            np.where(plain >= 20, of_text(_UPPER) / plain, np.nan),
            of_text(_DIGIT) / word_chars,
            1.0 - of_words(with_letter) / n_words,
            np.where(n_words >= 10, n_words / of_words(closing), np.nan),
            of_words(marked) / n_words,
            np.where(n_lines >= 3, n_dup_lines / n_lines, np.nan),
            np.where(n_words >= 10, n_repeat_words / n_words, np.nan),
            of_text(_LEADS * _LETTER) / word_chars,
            np.where(n_words >= 10, of_words(short) / of_words(with_letter), np.nan),
        ]
    counts = np.stack([n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words], axis=1)
    return counts, np.where((n_words > 0)[:, None], np.stack(stats, axis=1), np.nan)


def votes(stats: np.ndarray, rules: tuple[Rule, ...] = RULES) -> np.ndarray:
    """1, -1 or 0 of each rule (column) about each text (row)."""
    out = np.zeros(stats.shape, np.int8)
    for j, r in enumerate(rules):
        x = stats[:, j]
        with np.errstate(invalid="ignore"):
            out[:, j] = np.where((x >= r.good[0]) & (x <= r.good[1]), 1, np.where((x < r.fair[0]) | (x > r.fair[1]), -1, 0))
    return out


@dataclass
class VoteModel:
    """Share of good documents, and for each rule how often it is right about good and about bad ones when it votes."""

    share: float
    right_good: np.ndarray
    right_bad: np.ndarray

    def posterior(self, cast: np.ndarray) -> np.ndarray:
        """The probability of good for rows of votes."""
        up, down = cast == 1, cast == -1
        good = up @ np.log(self.right_good) + down @ np.log1p(-self.right_good) + np.log(self.share)
        bad = down @ np.log(self.right_bad) + up @ np.log1p(-self.right_bad) + np.log1p(-self.share)
        return 1.0 / (1.0 + np.exp(np.clip(bad - good, -700.0, 700.0)))


def estimate(cast: np.ndarray, n: np.ndarray, rounds: int = 200, tolerance: float = 1e-10) -> VoteModel:
    """Expectation-maximisation over patterns of votes and how many documents have each.

    It starts from what most of a document's rules say. Rules count as better than chance about both kinds (0.55 or more),
    which keeps the kinds from changing places, and as never perfect; each count begins with one right and one wrong vote.
    """
    voted = (cast != 0).any(1)
    cast, n = cast[voted], n[voted].astype(np.float64)
    half = np.full(cast.shape[1], 0.75)
    if not len(cast):
        return VoteModel(0.5, half, half.copy())
    up, down = (cast == 1).astype(np.float64), (cast == -1).astype(np.float64)
    good = 0.5 + 0.5 * cast.sum(1) / np.abs(cast).sum(1)
    model, before = None, -np.inf
    for _ in range(rounds):
        weight_good, weight_bad = n * good, n * (1.0 - good)
        share = np.clip((weight_good.sum() + 1.0) / (n.sum() + 2.0), 1e-6, 1.0 - 1e-6)
        right_good = (weight_good @ up + 1.0) / (weight_good @ (up + down) + 2.0)
        right_bad = (weight_bad @ down + 1.0) / (weight_bad @ (up + down) + 2.0)
        model = VoteModel(float(share), np.clip(right_good, 0.55, 0.999), np.clip(right_bad, 0.55, 0.999))
        good = model.posterior(cast)
        moved = float(np.abs(n * good).sum())
        if abs(moved - before) <= tolerance * n.sum():
            break
        before = moved
    return model


def _codes(cast: np.ndarray) -> np.ndarray:
    """A number for each pattern: the votes as digits to the base of three."""
    return (cast.astype(np.int64) + 1) @ 3 ** np.arange(cast.shape[1], dtype=np.int64)


def _patterns(codes: np.ndarray, rules: int) -> np.ndarray:
    return ((codes[:, None] // 3 ** np.arange(rules, dtype=np.int64)) % 3 - 1).astype(np.int8)


def with_votes(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The rows (of ``carry``, or all columns) with the counts and ``votes``, the number of their pattern."""
    fields = [f for f in docs.schema.fields if f.name.lower() not in RESULT and (carry is None or f.name in carry)]
    schema = T.StructType([*fields, *(T.StructField(c, T.LongType()) for c in (*COUNTS, "votes"))])
    own = [F.col(f"`{f.name}`") for f in fields]
    rows = docs.select(*own, F.col(f"`{text}`").cast("binary").alias("text_to_judge_"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in terms.slices(batch, len(fields)):
                counts, stats = statistics(terms.bytes_of(part.column(len(fields))))
                columns = [*part.columns[: len(fields)], *(pa.array(c) for c in counts.T), pa.array(_codes(votes(stats)))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(each, schema)


def judge(
    docs: DataFrame,
    text: str = "text",
    carry: list[str] | None = None,
    threshold: float = 0.5,
    least_words: int = 50,
    most_repeated: int = 50,
) -> DataFrame:
    """The rows with their counts, ``votes``, ``posterior`` (of being good), ``base_failed`` and ``kept``.

    ``carry`` names the input columns to carry through (all, if not given). The base fails texts with fewer than ``least_words`` words and those of whose words more than ``most_repeated`` percent are in
    repeated windows.
    """
    spark = docs.sparkSession
    # Counts and votes are written once and read twice, for the patterns and for the result.
    rows = written(with_votes(docs, text, carry), "votes")
    patterns = rows.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).toArrow()  # at most 3 ** len(RULES) rows
    codes, n = (patterns.column(c).to_numpy() for c in ("votes", "n"))
    order = np.argsort(codes)
    codes, n = codes[order], n[order]
    cast = _patterns(codes, len(RULES))
    found = estimate(cast, n).posterior(cast)
    table = spark.createDataFrame(pa.table({"votes": pa.array(codes, pa.int64()), "posterior": pa.array(found, pa.float64())}))
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    judged = rows.join(F.broadcast(table), "votes").withColumn("base_failed", failed)
    own = [F.col(f"`{f}`") for f in rows.columns if f != "votes"]
    kept = (~F.col("base_failed") & (F.col("posterior") >= threshold)).alias("kept")
    return judged.select(*own, "votes", "posterior", "base_failed", kept)
