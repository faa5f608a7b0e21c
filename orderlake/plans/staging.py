"""Clean, type and rename RAW rows; latest version where a key can come again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions.scalars import (
    city_of,
    file_date,
    first_whole,
    loaded_at,
    text_hash,
    to_whole,
    try_amount,
    try_whole,
)
from orderlake.operators.versions import dedup_latest, first_per_group

MONEY = "decimal(10,2)"


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    latest = dedup_latest(raw_orders, "order_id", tiebreak=["order_status", "sales_amount"])
    return latest.select(
        "order_id",
        "order_timestamp",
        "order_date",
        F.col("user_id").alias("customer_id"),
        F.col("r_id").alias("restaurant_id"),
        city_of("restaurant_city").alias("city"),
        "cuisine",
        "items_count",
        "sales_qty",
        "subtotal",
        "discount",
        "delivery_fee",
        "gst",
        "sales_amount",
        "currency",
        "payment_method",
        "order_status",
        (F.col("order_status") == "Delivered").alias("is_delivered"),
        "customer_rating",
        "delivery_time_min",
        "_source_file",
        loaded_at().alias("_loaded_at"),
    )


def latest_order_items(raw_items: DataFrame) -> DataFrame:
    return dedup_latest(raw_items, "order_item_id", tiebreak=["r_id", "f_id", "quantity", "line_amount"])


def typed_order_items(latest_items: DataFrame) -> DataFrame:
    return latest_items.select(
        "order_item_id",
        "order_id",
        F.col("r_id").alias("restaurant_id"),
        "f_id",
        F.col("price").cast(MONEY).alias("price"),
        F.col("quantity").cast("bigint").alias("quantity"),
        F.col("line_amount").cast(MONEY).alias("line_amount"),
        "_source_file",
        loaded_at().alias("_loaded_at"),
    )


def stg_order_items(raw_items: DataFrame) -> DataFrame:
    return typed_order_items(latest_order_items(raw_items))


def _with_number(raw_restaurants: DataFrame) -> DataFrame:
    numbered = raw_restaurants.select("*", try_whole("id").alias("restaurant_id"), file_date().alias("_file_date"))
    return numbered.where(F.col("restaurant_id").isNotNull())


def _newest_load() -> list[Column]:
    return [F.col("_loaded_at").desc_nulls_last(), F.col("cost").asc_nulls_last(), F.col("rating").asc_nulls_last()]


def _parsed_restaurants(rows: DataFrame) -> DataFrame:
    return rows.select(
        "restaurant_id",
        F.col("name").alias("restaurant_name"),
        city_of("city").alias("city"),
        try_amount(F.when(F.col("rating") != "--", F.col("rating")), 3, 1).alias("rating"),
        first_whole("rating_count").alias("rating_count"),
        first_whole("cost").alias("cost_for_two"),
        "cuisine",
        F.col("lic_no").alias("license_no"),
        "_file_date",
        "_source_file",
        loaded_at().alias("_loaded_at"),
    )


def stg_restaurant_versions(raw_restaurants: DataFrame) -> DataFrame:
    """Every version of every restaurant, one per file day (a day may have been loaded twice)."""
    keys = ["restaurant_id", "_file_date"]
    return _parsed_restaurants(first_per_group(_with_number(raw_restaurants), keys, _newest_load()))


def stg_restaurants(raw_restaurants: DataFrame) -> DataFrame:
    """The newest load of the newest file day; one shuffle, without building all versions first."""
    order = [F.col("_file_date").desc_nulls_last(), *_newest_load()]
    latest = first_per_group(_with_number(raw_restaurants), ["restaurant_id"], order)
    return _parsed_restaurants(latest).drop("_file_date")


def stg_users(raw_users: DataFrame) -> DataFrame:
    return raw_users.where(try_whole("user_id").isNotNull()).select(
        to_whole("user_id").alias("customer_id"),
        F.col("name").alias("customer_name"),
        F.lower("email").alias("email"),
        try_whole("age").alias("age"),
        "gender",
        "marital_status",
        "occupation",
        F.col("monthly_income").alias("income_band"),
        "education",
        try_whole("family_size").alias("family_size"),
    )


def stg_food(raw_food: DataFrame) -> DataFrame:
    return raw_food.where(F.col("f_id").isNotNull()).select(
        "f_id", F.col("item").alias("food_name"), F.initcap("veg_or_non_veg").alias("veg_or_non_veg")
    )


def stg_menu(raw_menu: DataFrame) -> DataFrame:
    typed = raw_menu.select(
        "menu_id", try_whole("r_id").alias("restaurant_id"), "f_id", "cuisine", try_amount("price").alias("price")
    )
    return typed.where(F.col("restaurant_id").isNotNull() & (F.col("price") > 0))


def latest_reviews(raw_reviews: DataFrame) -> DataFrame:
    """Latest commented version of each review.

    Rows without a comment are left out first, so a later empty re-send does not win.
    """
    commented = raw_reviews.where(F.col("comment").isNotNull())
    latest = dedup_latest(commented, "review_id", tiebreak=["rating", "comment"])
    return latest.select(
        "review_id",
        "order_id",
        F.col("user_id").cast("bigint").alias("customer_id"),
        F.col("restaurant_id").cast("bigint").alias("restaurant_id"),
        F.col("rating").cast("bigint").alias("rating"),
        "comment",
        text_hash("comment").alias("comment_hash"),
        F.col("review_date").cast("date").alias("review_date"),
        "_source_file",
        loaded_at().alias("_loaded_at"),
    )


def with_city(reviews: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Reviews with the restaurant's current city, which changes without the review; with or without their comments."""
    cities = restaurants.select("restaurant_id", "city")
    columns = [
        "review_id",
        "order_id",
        "customer_id",
        "restaurant_id",
        "rating",
        "comment",
        "comment_hash",
        "review_date",
        "city",
        "_source_file",
        "_loaded_at",
    ]
    return reviews.join(cities, "restaurant_id", "left").select(*[c for c in columns if c == "city" or c in reviews.columns])


def stg_reviews(raw_reviews: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Latest reviews with their city, looked up after the latest version is chosen."""
    return with_city(latest_reviews(raw_reviews), restaurants)
