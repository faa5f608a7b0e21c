"""Dimensions, facts and business marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake import settings
from orderlake.functions.scalars import days_between, mask_email, ratio, strict_greatest, strict_least
from orderlake.operators.deltas import count_of, rows_in, signed, sum_of
from orderlake.operators.versions import as_of_join, first_per_group, scd2_ranges

TRACKED = ["restaurant_name", "city", "cuisine", "rating", "rating_count", "cost_for_two"]

ORDER_COLUMNS = [
    "order_id",
    "order_timestamp",
    "order_date",
    "customer_id",
    "restaurant_id",
    "city",
    "cuisine",
    "payment_method",
    "order_status",
    "is_delivered",
    "items_count",
    "sales_qty",
    "subtotal",
    "discount",
    "delivery_fee",
    "gst",
    "sales_amount",
    "customer_rating",
    "delivery_time_min",
    "_source_file",
    "_loaded_at",
]


def _paid_if(condition: Column, amount: str = "sales_amount") -> Column:
    return F.when(condition, F.col(amount)).otherwise(F.lit(0))


# --- dimensions --------------------------------------------------------------------------


def age_segment(age: str = "age") -> Column:
    """The generation by age; the last one has no upper bound."""
    segment = F.when(F.col(age).isNull(), "Unknown")
    for below, name in ((25, "Gen Z"), (40, "Millennial"), (55, "Gen X")):
        segment = segment.when(F.col(age) < below, name)
    return segment.otherwise("Boomer")


def dim_customer(users: DataFrame, pii_masking: bool = False) -> DataFrame:
    return users.select(
        "customer_id",
        "customer_name",
        (mask_email("email") if pii_masking else F.col("email")).alias("email"),
        "age",
        age_segment().alias("age_segment"),
        "gender",
        "marital_status",
        "occupation",
        "income_band",
        "education",
        "family_size",
    )


def analyst_projection(df: DataFrame) -> DataFrame:
    """Columns analysts may see: no personal data, no technical columns."""
    return df.select(*[c for c in df.columns if not c.startswith("_") and c not in settings.HIDDEN_COLUMNS])


def dim_restaurants(restaurants: DataFrame) -> DataFrame:
    return restaurants.select(
        "restaurant_id", "restaurant_name", "city", "cuisine", "rating", "rating_count", "cost_for_two"
    )


def dim_food(food: DataFrame) -> DataFrame:
    return food.select("f_id", "food_name", "veg_or_non_veg")


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes for rows with a ``date_day``."""
    day = F.col("date_day")
    return days.select(
        "date_day",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.monthname(day).alias("month_name"),
        F.dayname(day).alias("day_name"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    )


def date_spine(bounds: DataFrame) -> DataFrame:
    """One row per day from the one-row frame (first_day, last_day)."""
    return bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("date_day"))


def dim_date(spark, first_day: str = settings.CALENDAR_FROM, last_day: str = settings.CALENDAR_TO) -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(first_day).cast("date").alias("first_day"), F.lit(last_day).cast("date").alias("last_day")
    )
    return calendar(date_spine(bounds))


def dim_restaurants_history(versions: DataFrame) -> DataFrame:
    """Event-time history: a version is valid from the day of its file."""
    beginning = F.lit(settings.BEGINNING_OF_TIME).cast("timestamp_ntz")
    dated = versions.select(
        "restaurant_id",
        *TRACKED,
        F.coalesce(F.col("_file_date").cast("timestamp_ntz"), beginning).alias("valid_from"),
        "_source_file",
    )
    ranges = scd2_ranges(dated, "restaurant_id", "valid_from", TRACKED)
    version_key = F.concat(F.col("restaurant_id").cast("string"), F.lit("-"), F.date_format("valid_from", "yyyyMMdd"))
    return ranges.select(
        version_key.alias("restaurant_version_key"),
        "restaurant_id",
        *TRACKED,
        "valid_from",
        "valid_to",
        "is_current",
        "_source_file",
    )


# --- facts -------------------------------------------------------------------------------


def fct_orders(orders: DataFrame) -> DataFrame:
    return orders.select(*ORDER_COLUMNS)


def fct_order_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    placed = orders.select("order_id", F.col("order_timestamp").alias("order_ts"), "order_date", "city")
    return items.join(placed, "order_id").select(
        "order_item_id",
        "order_id",
        "restaurant_id",
        "f_id",
        "order_ts",
        "order_date",
        "city",
        "price",
        "quantity",
        "line_amount",
        "_source_file",
        "_loaded_at",
    )


def fct_orders_point_in_time(
    orders: DataFrame, history: DataFrame, restaurants: DataFrame, span: DataFrame | None = None
) -> DataFrame:
    """Each order with the restaurant's price and rating when it was placed, and today's.

    ``span`` may be any frame whose ``order_timestamp`` covers the orders (RAW rows, say).
    """
    versions = history.select(
        "restaurant_id",
        "valid_from",
        "valid_to",
        "restaurant_version_key",
        F.col("cost_for_two").alias("cost_for_two_at_order"),
        F.col("rating").alias("rating_at_order"),
    )
    current = restaurants.select(
        "restaurant_id",
        F.col("cost_for_two").alias("cost_for_two_current"),
        F.col("rating").alias("rating_current"),
    )
    placed = orders.select(
        "order_id",
        "order_timestamp",
        "order_date",
        "restaurant_id",
        "city",
        "order_status",
        "is_delivered",
        "sales_amount",
    )
    span = orders if span is None else span
    joined = as_of_join(placed, versions, "restaurant_id", "order_timestamp", span, "order_timestamp")
    return joined.join(current, "restaurant_id", "left").select(
        *placed.columns,
        "restaurant_version_key",
        "cost_for_two_at_order",
        "rating_at_order",
        "cost_for_two_current",
        "rating_current",
    )


# --- business marts ----------------------------------------------------------------------


def mart_daily_city_revenue(orders: DataFrame) -> DataFrame:
    totals = orders.groupBy("order_date", "city").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if("is_delivered").alias("delivered_orders"),
        F.count_if(F.col("order_status") == "Cancelled").alias("cancelled"),
        F.sum(_paid_if(F.col("is_delivered"))).alias("gmv"),
    )
    return totals.select(
        "order_date",
        "city",
        "orders",
        "delivered_orders",
        ratio("cancelled", "orders", 4).alias("cancelled_rate"),
        "gmv",
        ratio("gmv", "delivered_orders", 2).alias("avg_order_value"),
    )


def restaurant_sums(orders: DataFrame) -> DataFrame:
    """Signed sums per restaurant, from which its performance is computed."""
    paid = _paid_if(F.col("is_delivered"))
    return orders.groupBy("restaurant_id").agg(
        rows_in().alias("orders"),
        sum_of(paid).alias("revenue"),
        count_of(paid.isNotNull()).alias("priced"),
        sum_of(F.col("customer_rating")).alias("rating"),
        count_of(F.col("customer_rating").isNotNull()).alias("rated"),
        sum_of(F.col("delivery_time_min")).alias("minutes"),
        count_of(F.col("delivery_time_min").isNotNull()).alias("timed"),
    )


def restaurant_performance(sums: DataFrame, restaurants: DataFrame) -> DataFrame:
    """The performance mart from ``restaurant_sums``."""

    def mean(total: str, n: str, digits: int) -> Column:
        return F.round(F.try_divide(F.col(total).cast("double"), F.col(n).cast("double")), digits)

    names = restaurants.select("restaurant_id", "restaurant_name", "city", "cuisine")
    return sums.join(names, "restaurant_id", "left").select(
        "restaurant_id",
        "restaurant_name",
        "city",
        "cuisine",
        "orders",
        F.when(F.col("priced") > 0, F.col("revenue")).alias("revenue"),
        mean("rating", "rated", 2).alias("avg_customer_rating"),
        mean("minutes", "timed", 1).alias("avg_delivery_min"),
    )


def mart_restaurant_performance(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Orders are summed per restaurant before the names are joined on."""
    return restaurant_performance(restaurant_sums(signed(orders)), restaurants)


def delivery_minutes(orders: DataFrame) -> DataFrame:
    """Signed numbers of delivered orders per city, hour and whole minute."""
    hour = F.hour("order_timestamp").alias("order_hour")
    return orders.where("is_delivered").groupBy("city", hour, "delivery_time_min").agg(rows_in().alias("n"))


def delivery_sla(minutes: DataFrame) -> DataFrame:
    """The delivery mart from ``delivery_minutes``: exact percentiles by the cumulative numbers."""
    shares = F.percentile("delivery_time_min", F.array(F.lit(0.5), F.lit(0.9)), F.col("n"))
    return (
        minutes.groupBy("city", "order_hour")
        .agg(F.sum("n").alias("delivered_orders"), shares.alias("p"))
        .select(
            "city",
            "order_hour",
            "delivered_orders",
            F.round(F.col("p")[0], 1).alias("p50"),
            F.round(F.col("p")[1], 1).alias("p90"),
        )
    )


def mart_delivery_sla(orders: DataFrame) -> DataFrame:
    """Exact percentiles from a histogram.

    Orders are first counted per whole minute in each task, so the percentile step sees one row
    per (city, hour, minute) however many orders a city has.
    """
    return delivery_sla(delivery_minutes(signed(orders)))


def price_changes(history: DataFrame) -> DataFrame:
    """Versions whose price differs from the known price before."""
    by_start = Window.partitionBy("restaurant_id").orderBy(F.col("valid_from").asc_nulls_first())
    priced = history.select(
        "restaurant_id",
        F.col("valid_from").cast("date").alias("changed_on"),
        F.lag("cost_for_two").over(by_start).alias("old_cost_for_two"),
        F.col("cost_for_two").alias("new_cost_for_two"),
    )
    return priced.where(
        F.col("old_cost_for_two").isNotNull() & ~F.col("new_cost_for_two").eqNullSafe(F.col("old_cost_for_two"))
    )


def restaurant_days(orders: DataFrame) -> DataFrame:
    """Signed sums per restaurant and day."""
    paid_null = F.col("is_delivered") & F.col("sales_amount").isNull()
    return orders.groupBy("restaurant_id", F.col("order_timestamp").cast("date").alias("day")).agg(
        rows_in().alias("n"),
        sum_of(_paid_if(F.col("is_delivered"))).alias("revenue"),
        count_of(paid_null).alias("unpriced"),
    )


CHANGE = ["restaurant_id", "changed_on", "old_cost_for_two", "new_cost_for_two"]


def named_changes(history: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Price changes with what the mart says of their restaurants."""
    names = restaurants.select("restaurant_id", "restaurant_name", "city")
    return price_changes(history).join(names, "restaurant_id", "left").select(*CHANGE, "restaurant_name", "city")


def windows(changes: DataFrame, days: int) -> DataFrame:
    """Each change with the days before and after it."""
    offsets = F.explode(F.sequence(F.lit(-days), F.lit(days - 1)))
    return changes.select("*", offsets.alias("offset")).select("*", F.date_add("changed_on", F.col("offset")).alias("day"))


def price_change_rows(changes: DataFrame, daily: DataFrame, last_order: Column, days: int = 7) -> DataFrame:
    """Rows of the price change mart for ``named_changes``, from ``restaurant_days`` and the time of the last order."""
    before, after = F.col("offset") < 0, F.col("offset") >= 0
    sums = (
        windows(changes, days)
        .join(daily, ["restaurant_id", "day"], "left")
        .groupBy(*changes.columns)
        .agg(
            F.coalesce(F.sum(F.when(before, F.col("n"))), F.lit(0)).alias(f"orders_{days}d_before"),
            F.coalesce(F.sum(F.when(after, F.col("n"))), F.lit(0)).alias(f"orders_{days}d_after"),
            F.sum(F.when(before, F.col("revenue"))).alias("revenue_before"),
            F.sum(F.when(after, F.col("revenue"))).alias("revenue_after"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("all_orders"),
            F.coalesce(F.sum(F.when(before, F.col("unpriced"))), F.lit(0)).alias("unpriced_before"),
            F.coalesce(F.sum(F.when(after, F.col("unpriced"))), F.lit(0)).alias("unpriced_after"),
        )
    )

    def revenue(side: str) -> Column:
        # A sum over nothing but missing amounts is unknown, every other empty sum is 0.
        unknown = (F.col("all_orders") > 0) & (F.col(f"unpriced_{side}") == F.col("all_orders"))
        return F.when(~unknown, F.coalesce(F.col(f"revenue_{side}"), F.lit(0)))

    observed = days_between(F.col("changed_on"), last_order) + 1
    return sums.select(
        "restaurant_id",
        "restaurant_name",
        "city",
        "changed_on",
        "old_cost_for_two",
        "new_cost_for_two",
        ratio(F.col("new_cost_for_two") - F.col("old_cost_for_two"), "old_cost_for_two", 3).alias("price_change_pct"),
        f"orders_{days}d_before",
        f"orders_{days}d_after",
        revenue("before").alias(f"revenue_{days}d_before"),
        revenue("after").alias(f"revenue_{days}d_after"),
        strict_greatest(F.lit(0), strict_least(F.lit(days), observed)).alias("days_observed_after"),
    )


def mart_restaurant_price_changes(
    orders: DataFrame, history: DataFrame, restaurants: DataFrame, days: int = 7, span: DataFrame | None = None
) -> DataFrame:
    """Orders and delivered revenue in the days before and after each price change.

    A change takes effect at midnight, so the two windows are whole days: orders are summed per
    restaurant and day once, each change asks for its days by equality, and no range join is needed.
    ``span`` may be any frame with the same newest ``order_timestamp`` that is cheaper to read.
    """
    last_order = (orders if span is None else span).agg(F.max("order_timestamp").alias("ts"))
    changes = named_changes(history, restaurants)
    return price_change_rows(changes, restaurant_days(signed(orders)), last_order.scalar(), days)


def mart_daily_review_stats(reviews: DataFrame) -> DataFrame:
    totals = reviews.groupBy("review_date", "city").agg(
        F.count(F.lit(1)).alias("reviews"),
        F.count_if(F.col("rating") <= 2).alias("negative_reviews"),
        F.round(F.avg("rating"), 2).alias("avg_rating"),
    )
    return totals.select(
        "review_date",
        "city",
        "reviews",
        "negative_reviews",
        ratio("negative_reviews", "reviews", 4).alias("negative_share"),
        "avg_rating",
    )


def mart_review_insights(reviews: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled reviews per city, topic and sentiment; every label row counts.

    Labels are summed per review first, so a review with very many labels is one row in the join.
    """
    per_review = labels.groupBy("review_id", "topic", "sentiment_label").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("sentiment_score").alias("score_sum"),
        F.count("sentiment_score").alias("score_n"),
        F.count("key_issue").alias("issues"),
    )
    stars = reviews.select("review_id", "city", "rating")
    totals = (
        per_review.join(stars, "review_id")
        .groupBy("city", "topic", "sentiment_label")
        .agg(
            F.sum("n").alias("reviews"),
            F.sum("score_sum").alias("score_sum"),
            F.sum("score_n").alias("score_n"),
            F.sum(F.col("rating") * F.col("n")).alias("star_sum"),
            F.sum(F.when(F.col("rating").isNotNull(), F.col("n"))).alias("star_n"),
            F.sum("issues").alias("flagged_issues"),
        )
    )

    def mean(total: str, n: str, digits: int) -> Column:
        return F.round(F.try_divide(F.col(total).cast("double"), F.col(n).cast("double")), digits)

    return totals.select(
        "city",
        "topic",
        "sentiment_label",
        "reviews",
        mean("score_sum", "score_n", 3).alias("avg_sentiment_score"),
        mean("star_sum", "star_n", 2).alias("avg_star_rating"),
        "flagged_issues",
    )


def latest_enrichment(labels: DataFrame) -> DataFrame:
    """The newest label of each review; a label without a time counts as newest."""
    order = [F.col("enrichment_at").desc_nulls_first()] + [
        F.col(c).asc_nulls_last() for c in ("sentiment_label", "topic", "key_issue")
    ]
    newest = first_per_group(labels, ["review_id"], order)
    return newest.select("review_id", "sentiment_label", "topic", "key_issue")


def mart_review_search(
    reviews: DataFrame,
    history: DataFrame,
    orders: DataFrame,
    labels: DataFrame,
    span: DataFrame | None = None,
    texts: DataFrame | None = None,
) -> DataFrame:
    """One row per review with the restaurant version of its day, its order and its newest label.

    Comments stay out of the joins and are added by the review at the end, from ``texts`` (``review_id``, which comes once, and
    ``comment``) where that is cheaper to read than ``reviews``.
    """
    comments = (reviews if texts is None else texts).select(F.col("review_id").alias("_review_id"), "comment")
    rows = review_search_rows(reviews, history, orders, labels, span)
    columns = [*rows.columns[:4], "comment", *rows.columns[4:]]
    return rows.join(comments, F.col("review_id").eqNullSafe(F.col("_review_id")), "left").select(*columns)


def review_search_rows(
    reviews: DataFrame, history: DataFrame, orders: DataFrame, labels: DataFrame, span: DataFrame | None = None
) -> DataFrame:
    """The mart of searches without the comments.

    The order is attached only when it belongs to the reviewed restaurant. ``span`` may be any
    frame whose ``review_date`` covers the reviews.
    """
    versions = history.select(
        "restaurant_id",
        "valid_from",
        "valid_to",
        "restaurant_name",
        "cuisine",
        F.col("rating").alias("restaurant_rating_at_review"),
        F.col("cost_for_two").alias("cost_for_two_at_review"),
    )
    midnight = F.col("review_date").cast("timestamp_ntz")
    written = reviews.select(
        "review_id",
        "review_date",
        "city",
        "rating",
        "comment_hash",
        "restaurant_id",
        F.col("order_id").alias("_order_id"),
        midnight.alias("_review_ts"),
    )
    span = (reviews if span is None else span).select(midnight.alias("ts"))
    placed = orders.select(
        "order_id",
        F.col("restaurant_id").alias("_order_restaurant"),
        "order_date",
        "sales_amount",
        "delivery_time_min",
        "payment_method",
    )
    own_order = (F.col("_order_id") == F.col("order_id")) & (F.col("restaurant_id") == F.col("_order_restaurant"))
    # Labels first: both sides are already partitioned by review.
    labelled = written.join(latest_enrichment(labels), "review_id", "left")
    return (
        as_of_join(labelled, versions, "restaurant_id", "_review_ts", span, "ts")
        .join(placed, own_order, "left")
        .select(
            "review_id",
            "review_date",
            "city",
            "rating",
            "comment_hash",
            "restaurant_id",
            "restaurant_name",
            "cuisine",
            "restaurant_rating_at_review",
            "cost_for_two_at_review",
            "order_id",
            "order_date",
            "sales_amount",
            "delivery_time_min",
            "payment_method",
            "sentiment_label",
            "topic",
            "key_issue",
        )
    )
