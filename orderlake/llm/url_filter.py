"""URL filter: host and path rules first, gradient-boosted trees over lexical features for the rest.

Native: everything on the main path is DataFrame functions and Spark ML on the JVM.

Defined cases: a null URL, or one without ``://``, has an empty host and path, fits no rule and is
judged by the model from its (empty) text. Repeated rows are judged alike. Without any labelled URL, or
with labels of one kind only, there is nothing to learn: every URL no rule fits then gets that one
kind, or ``allow``. Input columns other than the URL are carried through; one that has the name of a result
column is replaced by it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import free_name, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RESULT = ("host", "path", "rule", "verdict")


@dataclass(frozen=True)
class Rule:
    """``host/path`` prefix: fits the host and its subdomains where the URL's path starts with ``/path``."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.text.split("/", 1)[1]


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise("")


def host_of(url: Column) -> Column:
    """From behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased."""
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From behind the host up to ``?``, ``#`` or the end."""
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, else null; of two equally long ones the first by text."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), [-ord(c) for c in r.text])):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.when(fits, F.lit(rule.text)).otherwise(chosen)
    return chosen


def rule_verdict(rule: Column, rules: Sequence[Rule]) -> Column:
    verdict = F.lit(None).cast("string")
    for r in rules:
        verdict = F.when(rule == r.text, r.verdict).otherwise(verdict)
    return verdict


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    n = F.greatest(F.length(text), F.lit(1))

    def share(c: Column) -> Column:
        return (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n

    letters = F.filter(F.array_distinct(F.split(text, "")), lambda c: c != "")
    return F.aggregate(letters, F.lit(0.0), lambda total, c: total - share(c) * F.log2(share(c)))


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def lexical_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Numbers read off the URL's characters; the suffix statistics are learned and joined separately."""
    whole = F.coalesce(url, F.lit(""))
    size = F.greatest(F.length(whole), F.lit(1))
    query = F.regexp_extract(whole, r"(?s)\?([^#]*)", 1)
    first = F.regexp_extract(path, r"(?s)^/([^/]*)/?", 1)
    return {
        "f_length": F.length(whole).cast("double"),
        "f_host_length": F.length(host).cast("double"),
        "f_path_length": F.length(path).cast("double"),
        "f_depth": F.size(F.filter(F.split(path, "/"), lambda s: s != "")).cast("double"),
        "f_labels": F.size(F.filter(F.split(host, r"\."), lambda s: s != "")).cast("double"),
        "f_digit_ratio": _count(whole, "[0-9]") / size,
        "f_host_digit_ratio": _count(host, "[0-9]") / F.greatest(F.length(host), F.lit(1)),
        "f_symbol_ratio": _count(whole, "[^A-Za-z0-9]") / size,
        "f_hyphens": _count(host, "-"),
        "f_entropy": _entropy(whole),
        "f_host_entropy": _entropy(host),
        "f_parameters": F.when(query == "", 0.0).otherwise(_count(query, "&") + 1.0),
        "f_fragment": F.contains(whole, F.lit("#")).cast("double"),
        "f_secure": F.startswith(whole, F.lit("https:")).cast("double"),
        "f_first_length": F.length(first).cast("double"),
    }


def _suffix_keys(host: Column, path: Column) -> dict[str, Column]:
    """What the suffix statistics are kept for: the last label of the host, and the path's first segment's
    and last segment's endings."""
    return {
        "s_top": F.substring_index(host, ".", -1),
        "s_first": F.right(F.regexp_extract(path, r"(?s)^/([^/]*)", 1), F.lit(3)),
        "s_file": F.right(F.regexp_extract(path, r"(?s)(\.[A-Za-z]+)$", 1), F.lit(6)),
    }


@dataclass
class UrlModel:
    """A fitted model: trees, the learned suffix tables and the verdict used where nothing was learned."""

    trees: GBTClassificationModel | None
    suffixes: dict[str, DataFrame]
    prior: float
    names: list[str]


def _features(df: DataFrame, url: str) -> DataFrame:
    u, h, p = F.col(url), F.col("host"), F.col("path")
    return df.withColumns(lexical_features(u, h, p) | _suffix_keys(h, p))


def _with_suffixes(df: DataFrame, suffixes: dict[str, DataFrame], prior: float) -> DataFrame:
    for key, stats in suffixes.items():
        df = df.join(stats, key, "left").withColumns(
            {f"f_{key}_rate": F.coalesce(f"f_{key}_rate", F.lit(prior)), f"f_{key}_seen": F.coalesce(f"f_{key}_seen", F.lit(0.0))}
        )
    return df


def _sample(data: DataFrame, label: str, rows: dict[int, int], max_rows: int, seed: int) -> DataFrame:
    """At most about ``max_rows`` rows with ``weight_``, the number of rows each stands for; ``rows`` counts each label's.

    Equal feature rows are counted first. The more rows one has the likelier it stays, a hot one always; both
    labels stay, since each has half the room at least.
    """
    if sum(rows.values()) <= max_rows:
        return data.withColumn("weight_", F.lit(1.0))
    seen = [c for c in data.columns if c.startswith(("f_", "s_"))] + [label]
    counted = data.groupBy(*seen).agg(F.count(F.lit(1)).cast("double").alias("n_"))

    def step(kind: int) -> float:
        # Rows that one row of the sample stands for.
        return max(1.0, rows[kind] / max(max_rows / 2, max_rows - rows[1 - kind]))

    each = F.when(F.col(label) == 1, F.lit(step(1))).otherwise(F.lit(step(0)))
    drawn = F.pmod(F.xxhash64(*seen, F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    kept = counted.withColumn("step_", each).where(drawn < F.col("n_") / F.col("step_"))
    return kept.withColumn("weight_", F.greatest("n_", "step_")).drop("n_", "step_")


def fit(
    labelled: DataFrame,
    url: str = "url",
    label: str = "label",
    max_rows: int = 200_000,
    trees: int = 20,
    depth: int = 4,
    smoothing: float = 20.0,
    seed: int = 17,
) -> UrlModel:
    """Train from URLs labelled 1 (block) or 0 (allow); columns ``host`` and ``path`` must be there.

    The trees are fitted on at most about ``max_rows`` rows; where there are more, on distinct feature rows that are
    weighted by their labelled rows. The suffix statistics (share of blocked URLs, smoothed, and log count) are taken over all of them.
    """
    data = written(_features(labelled.where(F.col(label).isNotNull()), url).drop(url), "url_labels")
    total, blocked = data.agg(F.count(F.lit(1)), F.coalesce(F.sum(label), F.lit(0))).head()
    prior = blocked / total if total else 0.0
    names = [c for c in data.columns if c.startswith("f_")]
    if blocked in (0, total):
        return UrlModel(None, {}, prior, names)
    suffixes = {}
    for key in [c for c in data.columns if c.startswith("s_")]:
        n, hits = F.count(F.lit(1)), F.sum(label)
        rate = ((hits + F.lit(smoothing * prior)) / (n + F.lit(smoothing))).alias(f"f_{key}_rate")
        stats = data.groupBy(key).agg(rate, F.log1p(n.cast("double")).alias(f"f_{key}_seen"))
        suffixes[key] = written(stats, f"url_{key}")
        names += [f"f_{key}_rate", f"f_{key}_seen"]
    data = _sample(data, label, {1: blocked, 0: total - blocked}, max_rows, seed)
    ready = _with_suffixes(data, suffixes, prior)
    ready = VectorAssembler(inputCols=names, outputCol="features").transform(ready)
    ready = ready.select("features", F.col(label).cast("double").alias("label"), "weight_")
    classifier = GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed, maxBins=64, weightCol="weight_")
    return UrlModel(classifier.fit(ready), suffixes, prior, names)


def block_probability(df: DataFrame, model: UrlModel, url: str = "url", into: str = "block_probability") -> DataFrame:
    """Add the model's probability of ``block``; columns ``host`` and ``path`` must be there."""
    kept = df.columns
    if model.trees is None:
        return df.withColumn(into, F.lit(model.prior))
    ready = _with_suffixes(_features(df, url), model.suffixes, model.prior)
    ready = VectorAssembler(inputCols=model.names, outputCol="features").transform(ready)
    ready = model.trees.transform(ready)
    chance = vector_to_array("probability")[1].alias(into)
    return ready.select(*[F.col(f"`{c}`") for c in kept if c != into], chance)


def judge(pages: DataFrame, rules: Sequence[Rule], url: str = "url", labelled: DataFrame | None = None, **params) -> DataFrame:
    """Rows of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    The rule that fits decides; for the other URLs the model does. Its labelled URLs are ``labelled``
    (columns of the URL's name and ``label``: 1 block, 0 allow) or, without it, the URLs that a rule has decided:
    the model then extends the lists to URLs that they do not name.
    """
    own = [c for c in pages.columns if c.lower() not in RESULT]
    # Helper columns live in one struct, so that input columns of any name are safe.
    carried = free_name(["host", "path", "rule", url], "carried")
    base = pages.select(F.col(f"`{url}`").alias("u"), F.struct(*[F.col(f"`{c}`") for c in own]).alias(carried))
    base = base.withColumns({"host": host_of(F.col("u")), "path": path_of(F.col("u"))})
    base = base.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    by_rule = rule_verdict(F.col("rule"), rules)
    if labelled is None:
        known = base.where(F.col("rule").isNotNull()).select("u", "host", "path", (by_rule == "block").cast("int").alias("label"))
    else:
        known = labelled.select(F.col(f"`{url}`").alias("u"), "label")
        known = known.withColumns({"host": host_of(F.col("u")), "path": path_of(F.col("u"))})
    model = fit(known, "u", **params)
    scored = block_probability(base, model, "u", "chance")
    verdict = F.coalesce(by_rule, F.when(F.col("chance") >= 0.5, "block").otherwise("allow"))
    return scored.select(f"{carried}.*", "host", "path", "rule", verdict.alias("verdict"), F.col("chance").alias("block_probability"))
