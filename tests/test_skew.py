"""One key holds a third of the rows or more: results stay whole and the work is split."""

import collections

import pytest
from helpers import rows, ts
from pyspark.sql import functions as F

from orderlake.operators import quality, upsert, versions
from orderlake.plans import marts, reviews

N = 60000


@pytest.fixture
def small_partitions(spark):
    """Thresholds at which a laptop-sized partition counts as skewed; no broadcast joins."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def executed(df):
    found = df.collect()
    return found, df._jdf.queryExecution().executedPlan().toString()


def test_as_of_join_splits_a_hot_restaurant_month(spark, small_partitions):
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000)
    at = F.when(F.col("id") % 3 == 0, F.lit("2026-09-10 00:00:00").cast("timestamp_ntz")).otherwise(
        F.timestamp_add("HOUR", (F.col("id") % 9000).cast("int"), F.lit("2025-09-01 00:00:00").cast("timestamp_ntz"))
    )
    left = spark.range(0, N, 1, 16).select("id", hot.alias("k"), at.alias("at"), F.repeat(F.lit("x"), F.lit(40)).alias("pad"))
    right = spark.range(1000).select(
        F.col("id").alias("k"), F.explode(F.array(F.lit(0), F.lit(1))).alias("n")
    ).select(
        "k",
        F.when(F.col("n") == 0, F.lit("1900-01-01")).otherwise(F.lit("2026-09-05")).cast("timestamp_ntz").alias("valid_from"),
        F.when(F.col("n") == 0, F.lit("2026-09-05")).cast("timestamp_ntz").alias("valid_to"),
        F.col("n").alias("v"),
    )
    found, plan = executed(versions.as_of_join(left, right, "k", "at", left, "at"))
    assert len(found) == N
    assert "skew=true" in plan
    for r in found:
        assert r.v == (1 if r.at >= ts("2026-09-05") else 0)


def test_items_of_a_hot_order_are_split(spark, small_partitions):
    items = spark.range(0, N, 1, 16).select(
        F.col("id").alias("order_item_id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("order_id"),
        F.lit(5).alias("restaurant_id"),
        F.concat(F.lit("fd"), F.col("id").cast("string")).alias("f_id"),
        F.lit(1).alias("price"),
        F.lit(1).alias("quantity"),
        F.lit(1).alias("line_amount"),
        F.lit("raw/order_items/dt=2026-09-01/order_items.csv").alias("_source_file"),
        F.current_timestamp().alias("_loaded_at"),
    )
    orders = spark.range(0, N, 1, 16).select(
        F.col("id").alias("order_id"),
        F.lit("2026-09-01 10:00:00").cast("timestamp_ntz").alias("order_timestamp"),
        F.lit("2026-09-01").cast("date").alias("order_date"),
        F.lit("Pune").alias("city"),
    )
    found, plan = executed(marts.fct_order_items(items, orders))
    assert len(found) == N and "skew=true" in plan


def test_hot_text_without_a_vector_is_found_once(spark):
    texts = spark.range(N).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).cast("string").alias("comment"))
    texts = texts.select(F.sha2("comment", 256).alias("comment_hash"), "comment")
    known = texts.where("comment < '3'").select("comment_hash").distinct()
    expected = sorted((str(i),) for i in range(50) if not str(i) < "3")
    assert rows(reviews.texts_to_embed(texts, known), "comment") == expected


def test_counts_of_a_hot_value(spark):
    keys = spark.range(N).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 10).alias("k"))
    parent = spark.range(5).select(F.col("id").alias("p"))
    want = collections.Counter(-1 if i % 3 == 0 else i % 10 for i in range(N))
    assert rows(quality.orphans(keys, "k", parent, "p")) == sorted(
        ((k, n) for k, n in want.items() if k not in range(5)), key=lambda r: (True, str(r[0]))
    )


def test_upsert_of_a_key_sent_again_and_again(spark, tmp_path):
    def batch(status, load):
        return spark.range(3000).select(
            F.when(F.col("id") < 1000, F.lit(0)).otherwise(F.col("id")).alias("order_id"),
            F.lit("2026-09-01").cast("date").alias("order_date"),
            F.concat(F.lit(status), F.col("id").cast("string")).alias("status"),
            F.lit(f"raw/orders/dt={load}/orders.csv").alias("_source_file"),
            F.lit(load).cast("timestamp").alias("_loaded_at"),
        )

    path = str(tmp_path / "fct")
    for status, load in (("a", "2026-09-01"), ("b", "2026-09-02"), ("b", "2026-09-02")):
        upsert.upsert(spark, path, batch(status, load), "order_id", "order_date", ["status"])
    table = spark.read.parquet(path)
    assert table.count() == 2001
    assert rows(table.where("order_id = 0"), "status") == [("b0",)]
