"""Checks of the platform's own tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake import settings
from orderlake.operators.quality import drift, orphans, unexpected_values
from orderlake.operators.versions import dedup_latest


def key_checks(
    name: str, df: DataFrame, key: str, unique: bool, not_null: Sequence[str], warn: Sequence[str] = ()
) -> DataFrame:
    """Uniqueness of the key and all not-NULL checks of a table in one pass.

    Where the key must be unique, rows are counted per key once and every check is a sum over
    keys; otherwise nothing has to be grouped or moved.
    """
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(not_null)]
    if unique:
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *nulls)
    else:
        per_key = df.agg(*nulls)
    results = []
    if unique:
        repeated = F.count_if((F.col("_n") > 1) & F.col(key).isNotNull())
        results.append((f"unique {name}.{key}", "error", repeated))
    for i, c in enumerate(not_null):
        failures = F.coalesce(F.sum(f"_null_{i}"), F.lit(0))
        results.append((f"not_null {name}.{c}", "warn" if c in warn else "error", failures))
    totals = per_key.agg(*[f.alias(f"_r{i}") for i, (_, _, f) in enumerate(results)])
    rows = [
        F.struct(F.lit(check).alias("check_name"), F.lit(level).alias("severity"), F.col(f"_r{i}").alias("failures"))
        for i, (check, level, _) in enumerate(results)
    ]
    return totals.select(F.inline(F.array(*rows)))


def counted(check: str, severity: str, failing: DataFrame) -> DataFrame:
    return failing.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(check).alias("check_name"), F.lit(severity).alias("severity"), "failures"
    )


def with_status(report: DataFrame) -> DataFrame:
    """A failing check of severity "warn" does not stop a run, one of "error" does."""
    return report.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise(F.col("severity")))


def full_report(t) -> DataFrame:
    """All schema checks over the tables of ``t`` (attributes named like the tables).

    The checks run here, one after the other, and their few rows of totals are collected: in one query all of them would run at once,
    with the broadcasts of all their joins in the driver's memory together.
    """
    order_columns = ["order_id", "customer_id", "restaurant_id", "_loaded_at"]
    parts = (
        lambda: key_checks("stg_orders", t.stg_orders, "order_id", True, order_columns),
        lambda: key_checks("stg_order_items", t.stg_order_items, "order_item_id", True, ["order_item_id"]),
        lambda: key_checks("stg_restaurants", t.stg_restaurants, "restaurant_id", True, ["restaurant_id"]),
        lambda: key_checks("stg_users", t.stg_users, "customer_id", True, ["customer_id"]),
        lambda: key_checks("stg_reviews", t.stg_reviews, "review_id", True, ["review_id"]),
        lambda: key_checks("fct_orders", t.fct_orders, "order_id", True, ["order_id"]),
        lambda: key_checks(
            "dim_restaurants_history",
            t.restaurants_history,
            "restaurant_version_key",
            True,
            ["restaurant_version_key", "valid_from"],
        ),
        lambda: key_checks(
            "fct_orders_point_in_time",
            t.fct_orders_point_in_time,
            "order_id",
            False,
            ["restaurant_version_key"],
            warn=["restaurant_version_key"],
        ),
        lambda: key_checks("mart_review_search", t.mart_review_search, "review_id", True, ["review_id", "comment_hash"]),
        lambda: counted(
            "relationships fct_orders.customer_id",
            "error",
            orphans(t.fct_orders, "customer_id", t.dim_customer, "customer_id"),
        ),
        lambda: counted(
            "accepted_values fct_orders.order_status",
            "error",
            unexpected_values(t.fct_orders, "order_status", settings.ORDER_STATUSES),
        ),
    )
    rows = [row for part in parts for row in part().collect()]
    report = t.spark.createDataFrame(rows, "check_name string, severity string, failures bigint")
    return with_status(report)


def reconcile_orders(raw_orders: DataFrame, orders: DataFrame) -> DataFrame:
    """Facts must hold exactly the latest version of every RAW order."""
    latest = dedup_latest(raw_orders, "order_id", tiebreak=["order_status", "sales_amount"])

    def totals(df: DataFrame, delivered) -> DataFrame:
        return df.agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum(F.when(delivered, F.col("sales_amount")).otherwise(F.lit(0))).alias("delivered_gmv"),
            F.count_if(F.col("order_status") == "Refunded").alias("refunded"),
        )

    return drift(
        totals(latest, F.col("order_status") == "Delivered"),
        totals(orders, F.col("is_delivered")),
        ("raw", "fct"),
        ["orders", "delivered_gmv", "refunded"],
    )


def reconcile_order_items(raw_items: DataFrame, raw_orders: DataFrame, items: DataFrame) -> DataFrame:
    """Facts must hold every RAW item whose order exists, with the same total amount."""
    latest = dedup_latest(raw_items, "order_item_id", tiebreak=["r_id", "f_id", "quantity", "line_amount"])
    of_orders = latest.join(raw_orders.select("order_id"), "order_id", "left_semi")

    def totals(df: DataFrame) -> DataFrame:
        amount = F.sum(F.col("line_amount").cast("decimal(10,2)"))
        return df.agg(F.count(F.lit(1)).alias("items"), amount.alias("amount"))

    return drift(totals(of_orders), totals(items), ("raw", "fct"), ["items", "amount"])


def history_current(history: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Restaurants without exactly one current version, and a difference in the number of restaurants."""
    per_restaurant = history.groupBy("restaurant_id").agg(F.count_if("is_current").alias("current_versions"))
    several = per_restaurant.where(F.col("current_versions") != 1)
    counts = history.agg(F.countDistinct("restaurant_id").alias("n")).select(
        F.lit(None).cast("bigint").alias("restaurant_id"),
        F.abs(F.col("n") - restaurants.agg(F.count(F.lit(1)).alias("m")).scalar()).alias("current_versions"),
    )
    return several.unionByName(counts.where(F.col("current_versions") != 0))
