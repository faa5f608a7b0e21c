"""Data profile and reports on late rows, status changes, amounts, anomalies and feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake import settings
from orderlake.functions.scalars import file_date, ratio
from orderlake.operators.versions import first_per_group

# --- data profile ------------------------------------------------------------------------


def latest_dates(orders: DataFrame, review_stats: DataFrame) -> DataFrame:
    newest_review = review_stats.agg(F.max("review_date").alias("d"))
    return orders.agg(F.max("order_date").alias("latest_order_date")).select(
        "latest_order_date", newest_review.scalar().alias("latest_review_date")
    )


def categorical_values(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Distinct non-NULL values of category columns, one pass per table."""
    out = None
    for name, (df, columns) in tables.items():
        cells = [
            F.struct(F.lit(f"{name}.{c}".upper()).alias("column_name"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
        values = df.select(F.inline(F.array(*cells))).where(F.col("value").isNotNull()).distinct()
        out = values if out is None else out.unionByName(values)
    return out.orderBy("column_name", "value")


def top_cities(daily_revenue: DataFrame, n: int = settings.TOP_CITIES) -> DataFrame:
    totals = daily_revenue.groupBy("city").agg(F.sum("orders").alias("orders"))
    return totals.orderBy(F.col("orders").desc(), F.col("city").asc_nulls_last()).limit(n)


# --- versions ----------------------------------------------------------------------------


def first_files(raw_orders: DataFrame) -> DataFrame:
    """Day of the first file that brought each order."""
    return raw_orders.groupBy("order_id").agg(
        F.min("order_date").alias("order_date"), F.min(file_date()).alias("first_file_date")
    )


def late_arrivals(raw_orders: DataFrame) -> DataFrame:
    """Per order day: orders, and how many first came with a later day's file."""
    late = F.col("first_file_date") > F.col("order_date")
    days = first_files(raw_orders).groupBy("order_date").agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(late).alias("late_orders")
    )
    return days.withColumn("late_rate", ratio("late_orders", "orders", 4))


def status_changes(raw_orders: DataFrame) -> DataFrame:
    """Every change of an order's status from one file day to the next.

    Rows are first reduced to one per order and file day, which bounds the window of an order by
    the number of days, whatever is re-sent.
    """
    sent = raw_orders.select("order_id", "order_status", file_date().alias("file_day"), "_loaded_at")
    newest = [F.col("_loaded_at").desc_nulls_last(), F.col("order_status").asc_nulls_last()]
    daily = first_per_group(sent, ["order_id", "file_day"], newest)
    by_day = Window.partitionBy("order_id").orderBy(F.col("file_day").asc_nulls_first())
    steps = daily.select(
        "order_id",
        F.col("file_day").alias("changed_on"),
        F.lag("order_status").over(by_day).alias("from_status"),
        F.col("order_status").alias("to_status"),
        F.row_number().over(by_day).alias("_n"),
    )
    changed = (F.col("_n") > 1) & ~F.col("from_status").eqNullSafe(F.col("to_status"))
    return steps.where(changed).drop("_n")


def daily_feed_summary(
    raw_orders: DataFrame, raw_items: DataFrame, raw_reviews: DataFrame, raw_restaurants: DataFrame
) -> DataFrame:
    """What each day's files brought; the initial load is the row without a day.

    Rows that are not an order's first are status changes, so rows per file day minus first rows
    per file day gives them without looking at each order's versions.
    """
    metrics = ("orders_on_time", "orders_late", "status_changes", "order_items", "reviews", "restaurant_changes")

    def counted(rows: DataFrame, day: Column, **counts: Column) -> DataFrame:
        zeros = {m: F.lit(0) for m in metrics} | counts
        return rows.groupBy(day.alias("dt")).agg(*[F.sum(zeros[m]).alias(m) for m in metrics])

    first = first_files(raw_orders)
    late = F.coalesce(F.col("first_file_date") > F.col("order_date"), F.lit(False))
    parts = [
        counted(
            first,
            F.col("first_file_date"),
            orders_on_time=F.when(late, 0).otherwise(1),
            orders_late=F.when(late, 1).otherwise(0),
            status_changes=F.lit(-1),
        ),
        counted(raw_orders, file_date(), status_changes=F.lit(1)),
        counted(raw_items, file_date(), order_items=F.lit(1)),
        counted(raw_reviews, file_date(), reviews=F.lit(1)),
        counted(raw_restaurants, file_date(), restaurant_changes=F.lit(1)),
    ]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    return both.groupBy("dt").agg(*[F.sum(m).alias(m) for m in metrics])


# --- amounts and eligibility -------------------------------------------------------------


def amount_consistency(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders whose amounts do not add up, with the rule each one breaks.

    Tax is 5 % of the subtotal, halves rounded to the even number.
    """
    wrong_line = F.col("line_amount") != F.col("price") * F.col("quantity")
    lines = items.groupBy("order_id").agg(
        F.sum("line_amount").cast("decimal(38,2)").alias("items_total"), F.count_if(wrong_line).alias("wrong_lines")
    )
    tax = F.bround(F.col("subtotal").cast("double") * 0.05, 0).cast("bigint")
    paid = F.col("subtotal") - F.col("discount") + F.col("delivery_fee") + F.col("gst")
    rules = {
        "bad_subtotal": F.col("subtotal").cast("decimal(38,2)") != F.col("items_total"),
        "bad_lines": F.col("wrong_lines") > 0,
        "bad_gst": F.col("gst") != tax,
        "bad_sales_amount": F.col("sales_amount") != paid,
    }
    amounts = orders.select("order_id", "subtotal", "discount", "delivery_fee", "gst", "sales_amount")
    checked = amounts.join(lines, "order_id", "left").select(
        "*", *[F.coalesce(rule, F.lit(False)).alias(name) for name, rule in rules.items()]
    )
    broken = F.lit(False)
    for name in rules:
        broken = broken | F.col(name)
    return checked.where(broken)


def review_eligibility(reviews: DataFrame, raw_orders: DataFrame) -> DataFrame:
    """Reviews of orders that are unknown, were never delivered, or are not a day old."""
    ever_delivered = F.max(F.when(F.col("order_status") == "Delivered", 1).otherwise(0))
    orders = raw_orders.groupBy("order_id").agg(
        F.min("order_date").alias("order_date"), ever_delivered.alias("delivered")
    )
    reason = (
        F.when(F.col("delivered").isNull(), "unknown order")
        .when(F.col("delivered") == 0, "not delivered")
        .when(F.col("review_date") != F.date_add("order_date", 1), "not the next day")
    )
    joined = reviews.select("review_id", "order_id", "review_date").join(orders, "order_id", "left")
    checked = joined.select("review_id", "order_id", "review_date", "order_date", reason.alias("reason"))
    return checked.where(F.col("reason").isNotNull())


# --- anomalies ---------------------------------------------------------------------------


def anomaly_days(orders: DataFrame, reviews: DataFrame, percent: int = 140) -> DataFrame:
    """Days on which a city's delivery time or negative-review share is far above its other days.

    A day is reported when its value is at least ``percent`` of the value pooled over all other
    days of the city, so anything above a baseline of zero is. ``deviations`` says by how many
    standard deviations of the other days' values it lies above their mean; it is NULL where those
    do not vary. A city's only day has nothing to be compared with. Rows are summed per city and
    day first, so the window over a city holds one row per day; daily values are counted in whole
    thousandths, which keeps all sums exact.
    """
    minutes = orders.where(F.col("delivery_time_min").isNotNull()).groupBy(
        F.lit("delivery_time").alias("kind"), "city", F.col("order_date").alias("day")
    ).agg(F.count(F.lit(1)).alias("n"), F.sum("delivery_time_min").alias("total"))
    negative = reviews.groupBy(F.lit("negative_reviews").alias("kind"), "city", F.col("review_date").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("rating") <= 2).alias("total")
    )
    city = Window.partitionBy("kind", "city")
    daily = minutes.unionByName(negative).withColumn("v", F.expr("(total * 2000 + n) div (2 * n)"))

    def others(value: Column) -> Column:
        return F.sum(value).over(city) - value

    days = daily.select(
        "*",
        others(F.lit(1)).alias("other_days"),
        others(F.col("n")).alias("other_n"),
        others(F.col("total")).alias("other_total"),
        others(F.col("v")).alias("v_sum"),
        others(F.col("v") * F.col("v")).alias("v_squares"),
    )
    above = F.col("total") * F.col("other_n") * 100 >= F.col("other_total") * F.col("n") * percent
    spread = F.col("v_squares") * F.col("other_days") - F.col("v_sum") * F.col("v_sum")
    distance = (F.col("v") * F.col("other_days") - F.col("v_sum")).cast("double")
    return days.where((F.col("other_days") > 0) & (F.col("total") > 0) & above).select(
        "kind",
        "city",
        "day",
        "n",
        ratio("total", "n", 4).alias("observed"),
        ratio("other_total", "other_n", 4).alias("baseline"),
        F.when(spread > 0, F.round(distance / F.sqrt(spread.cast("double")), 2)).alias("deviations"),
    )


# --- traces ------------------------------------------------------------------------------


def append_traces(rows: DataFrame, path: str, text_column: str) -> None:
    """Append log rows, their JSON text stored as a variant; other text is stored as NULL."""
    rows.withColumn(text_column, F.try_parse_json(text_column)).write.mode("append").parquet(path)


def trace_fields(logs: DataFrame, trace: str, keep: list[str]) -> DataFrame:
    """Variant traces as one row per field: its value as text, and as a number where it is one.

    A missing trace gives one row without a field.
    """
    traces = logs.select(*keep, F.col(trace).alias("_trace"))
    fields = traces.lateralJoin(traces.sparkSession.tvf.variant_explode_outer(F.col("_trace").outer()))
    return fields.select(
        *keep,
        F.col("key"),
        F.try_variant_get("value", "$", "string").alias("value_text"),
        F.try_variant_get("value", "$", "bigint").alias("value_number"),
    )
