"""Marts of orders that a day changes instead of rebuilding them.

The merge of the orders tells its keys' old and new rows (``upsert(changes=)``). They are added, signed, to stored sums: per restaurant,
per city, hour and minute of delivery, and per restaurant and day. The performance and delivery marts are computed from
those sums; of the price change mart only the rows are computed anew whose days, version or names have changed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.operators import deltas
from orderlake.operators.upsert import distinct_values, in_partitions
from orderlake.plans import marts
from orderlake.session import shared_dir
from orderlake.sources import tables

PART = "part"


def month_of(day: str) -> Column:
    return F.coalesce(F.year(day) * 100 + F.month(day), F.lit(0))


#: Stored sums: how they come from signed orders, their keys, which of them counts rows, and their partition.
SUMS: dict[str, tuple[Callable[[DataFrame], DataFrame], list[str], str, Callable[[], Column]]] = {
    "restaurant_sums": (marts.restaurant_sums, ["restaurant_id"], "orders", lambda: deltas.dealt("restaurant_id")),
    "delivery_minutes": (marts.delivery_minutes, ["city", "order_hour", "delivery_time_min"], "n", lambda: deltas.dealt("city")),
    "restaurant_days": (marts.restaurant_days, ["restaurant_id", "day"], "n", lambda: month_of("day")),
}


def refresh_sums(spark: SparkSession, folder: str, orders: DataFrame, changes: DataFrame | None) -> dict[str, DataFrame]:
    """The stored sums below ``folder`` after the signed rows ``changes``; None computes them from all orders."""
    out = {}
    for name, (sums_of, keys, rows, part) in SUMS.items():
        path = f"{folder}/{name}"
        rebuild = changes is None or not tables.exists(spark, path)
        delta = sums_of(deltas.signed(orders) if rebuild else changes).withColumn(PART, part())
        out[name] = deltas.refresh(spark, path, delta, keys, rows, PART, rebuild)
    return out


def refresh_price_changes(
    spark: SparkSession, path: str, daily: DataFrame, changes: DataFrame | None, history: DataFrame, restaurants: DataFrame, days: int = 7
) -> None:
    """The price change mart, of which only affected rows are computed: those with one of the changed orders in their days, those
    whose days aren't over yet, and those that are new or say something else of price, name or city.

    ``daily`` are the stored sums per restaurant and day; ``changes`` None computes the whole mart. The mart is partitioned by the
    month of the change, and only months with an affected row are rewritten.
    """
    wanted = marts.named_changes(history, restaurants)
    month = month_of("changed_on").alias("_changed_month")

    def computed(affected: DataFrame, sums: DataFrame) -> DataFrame:
        return marts.price_change_rows(affected, sums, daily.agg(F.max("day")).scalar(), days).select("*", month)

    if changes is None or not tables.exists(spark, path):
        tables.full_refresh(computed(wanted, daily), path, ["_changed_month"])
        return
    staged = shared_dir(spark, "price_changes")
    try:
        tables.full_refresh(wanted, f"{staged}/wanted")
        wanted = spark.read.schema(wanted.schema).parquet(f"{staged}/wanted")
        stored = tables.read(spark, path)
        described = stored.select(*wanted.columns)
        touched = changes.select("restaurant_id", F.col("order_timestamp").cast("date").alias("day")).distinct()
        met = marts.windows(wanted, days).join(touched, ["restaurant_id", "day"], "left_semi").select(*wanted.columns)
        # Set operations, in which NULLs are equal.
        running = stored.where(F.col("days_observed_after") < days).select(*wanted.columns).intersect(wanted)
        affected = met.union(running).union(wanted.subtract(described)).distinct()
        tables.full_refresh(affected, f"{staged}/affected")
        affected = spark.read.schema(wanted.schema).parquet(f"{staged}/affected")
        gone = described.subtract(wanted)
        rewritten = set(distinct_values(affected.union(gone).select(month), "_changed_month"))
        if not rewritten:
            return
        key = ["restaurant_id", "changed_on"]
        left_alone = stored.where(in_partitions("_changed_month", rewritten))
        left_alone = left_alone.join(affected.union(gone).select(*key).distinct(), key, "left_anti")
        needed = set(distinct_values(marts.windows(affected, days).select(month_of("day").alias(PART)), PART))
        after = left_alone.unionByName(computed(affected, daily.where(in_partitions(PART, needed))))
        tables.full_refresh(after, f"{staged}/after")
        after = spark.read.schema(after.schema).parquet(f"{staged}/after")
        tables.overwrite_partitions(after, path, ["_changed_month"])
        tables.drop_partitions(spark, path, "_changed_month", rewritten - set(distinct_values(after, "_changed_month")))
    finally:
        tables.remove(spark, staged)
