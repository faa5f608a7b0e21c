"""The pipeline's stages on a small table with known cases, and the whole against its parts done by brute force."""

import random

import pytest
from test_bagminhash import brute as near_classes
from test_line_dedup import brute as line_rules
from test_packing import verify
from test_suffix_dedup import brute as repeats

import corpus_pipeline as pipeline

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and output rows on the smallest documents."""
    out, docs = [], spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in pipeline.STAGES:
        after = pipeline.written(stage(spark, docs, SF), f"test_{name}")
        out.append((name, docs, docs.collect(), after, after.collect()))
        docs = after
    return {name: rest for name, *rest in out}


def test_names_and_columns(stages):
    assert list(stages) == ["quality_classifier", "line_dedup", "bagminhash_near_dedup", "suffix_array_dedup", "packing"]
    for name, (before, _, after, rows) in stages.items():
        assert rows
        if name != "packing":
            assert after.schema.simpleString() == before.schema.simpleString()


def test_quality_keeps_the_good(spark, stages):
    _, before, _, after = stages["quality_classifier"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in after}
    good = [r.doc_id for r in before if labels.get(r.doc_id) == 1]
    bad = [r.doc_id for r in before if labels.get(r.doc_id) == 0]
    assert sum(k in kept for k in good) > 0.95 * len(good) and sum(k in kept for k in bad) < 0.2 * len(bad)


def test_lines(stages):
    _, before, _, after = stages["line_dedup"]
    want = {(k, t) for k, t, _, removed, _ in line_rules([(r.doc_id, r.text) for r in before]) if not removed or t.strip(" ")}
    assert {(r.doc_id, r.text) for r in after} == want
    assert all(r.n_chars == len(r.text) for r in after)


def test_near_duplicates(stages):
    _, before, _, after = stages["bagminhash_near_dedup"]
    assert sorted(r.doc_id for r in after) == sorted({c for _, c, _ in near_classes([(r.doc_id, r.text) for r in before])})


def test_passages(stages):
    _, before, _, after = stages["suffix_array_dedup"]
    want = {}
    for r, (_, spans, kept) in zip(before, repeats([r.text for r in before], pipeline.PASSAGE_BYTES), strict=True):
        text = kept.decode("utf-8", "ignore") if spans else r.text
        if not spans or text.strip(" "):
            want[r.doc_id] = text
    assert {r.doc_id: r.text for r in after} == want


def test_packing(spark, stages):
    from pyspark.sql import functions as F

    _, before, after, _ = stages["packing"]
    rows = after.withColumn("ids_crc32", F.crc32("tokens")).collect()
    assert verify(rows, {r.doc_id: r.text for r in before}, 4096) < 0.01
    assert pipeline.run(spark, SF).drop("tokens").exceptAll(after.drop("tokens")).count() == 0


def test_odd_tables(spark):
    rng = random.Random(1)
    schema = "doc_id long, text string, score double, kept string, n_chars int, others_ int, root string"
    rows = [(None, None), (1, None), (2, ""), (3, "one\ntwo"), (3, "one\ntwo"), (4, " ".join(str(rng.random()) for _ in range(5000)))]
    for docs in (spark.createDataFrame([(*r, 0.5, "k", 1, 2, "r") for r in rows], schema), spark.createDataFrame([], schema)):
        before = docs
        for name, stage in pipeline.STAGES[:-1]:
            docs = pipeline.written(stage(spark, docs, SF), f"odd_{name}")
            assert docs.schema.simpleString() == before.schema.simpleString(), name
        assert pipeline.STAGES[-1][1](spark, docs, SF).where("start = 0").count() == docs.count()
    slim = spark.createDataFrame([(1, "a b c"), (2, "d e f")], "doc_id long, text string")
    for _, stage in pipeline.STAGES[1:-1]:
        assert stage(spark, slim, SF).count() == 2
