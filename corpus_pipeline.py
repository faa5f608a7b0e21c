"""From raw documents to training sequences: five stages, each over all that the one before kept.

quality classifier, line dedup, near-duplicates, repeated passages, packing. Every stage but the last returns the
columns of its input; a changed text has its number of characters (``n_chars``) counted anew. A document that a stage empties is
dropped; one that was empty before is left to the other rules.

A null text counts as empty throughout. Tables without rows pass every stage; without ``labels`` of both kinds the first
stage keeps everything.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import bagminhash, line_dedup, packing, quality, suffix_dedup
from orderlake.llm.common import ship, table, written
from orderlake.session import tune

#: Documents with a lower score are rejected.
LEAST_SCORE = 0.5
#: Repeats from this many bytes on are cut. Meant are more than fifty words: those mostly have more bytes, but not always, and
#: this many bytes hold as few as 34 words (figures in the README).
PASSAGE_BYTES = 240


def _narrow(docs: DataFrame) -> DataFrame:
    """Key, text and the other columns as one, so that no name meets one of an operator's."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", (F.struct(*others) if others else F.lit(None)).alias("others_"))


def _widened(docs: DataFrame, df: DataFrame, changed: Column | None = None, text: Column | None = None) -> DataFrame:
    """The input's columns again, with the new text where it has changed; what was emptied is dropped."""
    columns = {c: F.col(c if c in ("doc_id", "text") else f"others_.`{c}`") for c in docs.columns}
    if changed is not None:
        df = df.where(~changed | (F.length(F.trim(F.coalesce(text, F.lit("")))) > 0))
        columns["text"] = F.when(changed, text).otherwise(F.col("text"))
        if "n_chars" in columns:
            count = F.length(text).cast(docs.schema["n_chars"].dataType)
            columns["n_chars"] = F.when(changed, count).otherwise(columns["n_chars"])
    return df.select(*[c.alias(name) for name, c in columns.items()])


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(tune(spark))
    labels = table(spark, sf_dir, "labels").where(F.coalesce(~quality.held_out(), F.lit(True)))
    model = quality.fit(docs.select("doc_id", "text"), labels)
    if model.weights is None:
        return docs
    scored = quality.score(_narrow(docs), model)
    return _widened(docs, scored.where(F.col("score") >= LEAST_SCORE))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(tune(spark))
    clean = line_dedup.remove_repeated_chunks(_narrow(docs))
    return _widened(docs, clean, F.col("n_removed") > 0, F.col("text"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(tune(spark))
    return _widened(docs, bagminhash.keep_one(_narrow(docs), threshold=0.8))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(tune(spark))
    cut = suffix_dedup.remove_repeats(_narrow(docs), min_bytes=PASSAGE_BYTES, kept_as_text=True)
    return _widened(docs, cut, F.size("spans") > 0, F.col("kept"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(tune(spark))
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, length=4096)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_filter),
    ("line_dedup", repeated_lines),
    ("bagminhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("packing", pack),
]

# Scores, signatures and tokens can't be had in SQL; tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of ``documents``; each stage's result is a written table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
