"""The driver's generic test tables read as the RAW tables of the platform.

All expressions are plain column arithmetic over whole tables; ``FIXTURES.md`` lists them. The
conditions real feeds show are planted on purpose: late orders, re-sent orders, a day loaded
twice, repeated values, junk ids, wrong amounts, missing comments.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.functions.scalars import text_hash

CUISINES = ("North Indian", "Chinese", "South Indian", "Pizzas")
INCOME_BANDS = ("No Income", "Below Rs.10000", "10001 to 25000", "25001 to 50000", "More than 50000")
PAYMENT_METHODS = ("UPI", "Card", "Wallet", "COD", "NetBanking")

Source = Callable[[str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _day(value, days=0) -> Column:
    day = F.col(value).cast("date") if isinstance(value, str) else value
    return F.date_add(day, F.lit(days) if isinstance(days, int) else days)


def _file(name: str, day: Column) -> Column:
    return F.concat(F.lit(f"raw/{name}/dt="), F.date_format(day, "yyyy-MM-dd"), F.lit(f"/{name}.csv"))


def _pick(values: tuple[str, ...], index: Column) -> Column:
    picked = F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))
    return F.when(index.isNotNull(), picked)


def _text(value: Column) -> Column:
    return value.cast("string")


def raw_restaurants(table: Source) -> DataFrame:
    s, k = F.col("s_suppkey"), F.col("k")
    feeds = F.sequence(F.lit(0), F.when(s % 10 == 3, 7).otherwise(6))
    nations = table("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    files = (
        table("supplier")
        .join(nations, "s_nationkey")
        .select("s_suppkey", "s_name", "n_name", F.explode(feeds).alias("feed"))
        # Feed 7 is the file of feed 2 loaded a day later with another price.
        .withColumn("k", F.when(F.col("feed") == 7, 2).otherwise(F.col("feed")))
        # Feed 5 repeats the values of feed 4.
        .withColumn("v", F.when(F.col("k") == 5, 4).otherwise(F.col("k")))
    )
    v, feed = F.col("v"), F.col("feed")
    day = _day(F.lit("1995-01-01").cast("date"), ((s % 700) * 3 + k * 290).cast("int"))
    rating = ((F.lit(10) + (s * 3 + v) % 40) / F.lit(10.0)).cast("decimal(3,1)")
    price = F.lit(200) + ((s * 7 + v * v) % 4) * 50 + F.when(feed == 7, 25).otherwise(0)
    dated = F.col("k") > 0
    return files.select(
        _text(F.col("feed")).alias("_idx"),
        F.when(s % 97 == 96, F.concat(F.lit("r"), _text(s))).otherwise(_text(s)).alias("id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("Area"), _text(s), F.lit(","), F.col("n_name")).alias("city"),
        F.when((s + v) % 11 == 0, "--").otherwise(_text(rating)).alias("rating"),
        F.concat(_text((s % 5 + 1) * 20), F.lit("+ ratings")).alias("rating_count"),
        F.concat(F.lit("₹ "), _text(price)).alias("cost"),
        _pick(CUISINES, s).alias("cuisine"),
        F.concat(F.lit("LIC"), _text(s)).alias("lic_no"),
        F.concat(F.lit("https://example.com/r/"), _text(s)).alias("link"),
        F.concat(F.lit("Address "), _text(s)).alias("address"),
        F.concat(F.lit("Menu/"), _text(s), F.lit(".json")).alias("menu"),
        F.when(dated, _file("restaurants", day)).alias("_source_file"),
        F.when(dated, _day(day, F.when(feed == 7, 2).otherwise(1)).cast("timestamp")).alias("_loaded_at"),
    )


def order_timestamp(day: str = "o_orderdate") -> Column:
    return F.timestamp_add("SECOND", (F.col("o_orderkey") * 7919 % 86400).cast("int"), F.col(day))


def raw_orders(table: Source) -> DataFrame:
    """First versions of all orders and the re-sent ones; a day's late orders come a day later."""
    line = table("lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        "l_suppkey",
        "l_partkey",
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )
    baskets = line.groupBy("o_orderkey").agg(
        F.min("l_suppkey").alias("r_id"),
        F.count(F.lit(1)).alias("items_count"),
        F.sum("quantity").alias("sales_qty"),
        F.sum((F.lit(100) + F.col("l_partkey") % 400) * F.col("quantity")).alias("subtotal"),
    )
    places = (
        table("supplier")
        .join(table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("s_suppkey").alias("r_id"), "n_name")
    )
    o, r = F.col("o_orderkey"), F.col("r_id")
    delivered = (o % 40) > 2
    late = o % 50 == 7
    resent = delivered & ~late & (o % 97 == 5)
    orders = (
        table("orders")
        .select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("placed"))
        .withColumn("order_date", F.col("placed").cast("date"))
        .join(baskets, "o_orderkey", "left")
        .join(places, "r_id", "left")
        .withColumn("discount", F.when(o % 5 == 0, F.expr("subtotal div 10")).otherwise(F.lit(0)).cast("bigint"))
        .withColumn("delivery_fee", ((o % 4) * 15).cast("bigint"))
        .withColumn("gst", F.bround(F.col("subtotal").cast("double") * 0.05, 0).cast("bigint"))
        .withColumn("version", F.explode(F.when(resent, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    )
    again = F.col("version") == 1
    lag = F.when(late | again, 1).otherwise(0)
    status = F.when(again | (o % 40 == 0), "Refunded").when(delivered, "Delivered").otherwise("Cancelled")
    arrives = delivered & ~again
    amount = F.col("subtotal") - F.col("discount") + F.col("delivery_fee") + F.col("gst")
    return orders.select(
        o.alias("order_id"),
        order_timestamp("placed").alias("order_timestamp"),
        "order_date",
        F.col("o_custkey").alias("user_id"),
        "r_id",
        F.concat(F.lit("Area"), _text(r), F.lit(","), F.col("n_name")).alias("restaurant_city"),
        _pick(CUISINES, r).alias("cuisine"),
        "items_count",
        "sales_qty",
        "subtotal",
        "discount",
        "delivery_fee",
        "gst",
        (amount + F.when(o % 211 == 0, 1).otherwise(0)).alias("sales_amount"),
        F.lit("INR").alias("currency"),
        _pick(PAYMENT_METHODS, o).alias("payment_method"),
        status.alias("order_status"),
        F.when(arrives & (o % 10 < 7), (o * 13) % 5 + 1).alias("customer_rating"),
        F.when(arrives, (o * 31) % 80 + 8).alias("delivery_time_min"),
        _file("orders", _day("order_date", lag)).alias("_source_file"),
        _day("order_date", lag + 1).cast("timestamp").alias("_loaded_at"),
    )


def raw_order_items(table: Source) -> DataFrame:
    key, number = F.col("l_orderkey"), F.col("l_linenumber")
    price = F.lit(100) + F.col("l_partkey") % 400
    quantity = F.col("l_quantity").cast("bigint")
    wrong = F.when((key % 307 == 0) & (number == 1), 1).otherwise(0)
    return table("lineitem").select(
        (key * 10 + number).alias("order_item_id"),
        key.alias("order_id"),
        F.col("l_suppkey").alias("r_id"),
        F.concat(F.lit("fd"), _text(F.col("l_partkey"))).alias("f_id"),
        price.alias("price"),
        quantity.alias("quantity"),
        (price * quantity + wrong).alias("line_amount"),
        _file("order_items", _day("l_shipdate")).alias("_source_file"),
        _day("l_shipdate", 1).cast("timestamp").alias("_loaded_at"),
    )


def raw_users(table: Source) -> DataFrame:
    c = F.col("c_custkey")
    return table("customer").select(
        _text(c).alias("_idx"),
        F.when(c % 89 == 88, F.concat(F.lit("u"), _text(c))).otherwise(_text(c)).alias("user_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("User"), _text(c), F.lit("@Example.com")).alias("email"),
        F.concat(F.lit("pw"), _text(c)).alias("password"),
        F.when(c % 17 == 0, "n/a").otherwise(_text(c % 50 + 18)).alias("age"),
        _pick(("Female", "Male"), c).alias("gender"),
        _pick(("Single", "Married", "Prefer not to say"), c).alias("marital_status"),
        F.col("c_mktsegment").alias("occupation"),
        _pick(INCOME_BANDS, c).alias("monthly_income"),
        _pick(("Graduate", "Post Graduate", "Ph.D", "School"), c).alias("education"),
        _text(c % 6 + 1).alias("family_size"),
        F.lit(None).cast("string").alias("_source_file"),
        F.lit(None).cast("timestamp").alias("_loaded_at"),
    )


def raw_food(table: Source) -> DataFrame:
    p = F.col("p_partkey")
    return table("part").select(
        _text(p).alias("_idx"),
        F.when(p % 101 != 100, F.concat(F.lit("fd"), _text(p))).alias("f_id"),
        F.col("p_name").alias("item"),
        F.when(p % 3 == 0, "NON-VEG").otherwise("VEG").alias("veg_or_non_veg"),
        F.lit(None).cast("string").alias("_source_file"),
        F.lit(None).cast("timestamp").alias("_loaded_at"),
    )


def raw_menu(table: Source) -> DataFrame:
    p = F.col("p_partkey")
    restaurants = table("supplier").agg(F.count(F.lit(1)).alias("n")).scalar()
    return table("part").select(
        _text(p).alias("_idx"),
        F.concat(F.lit("mn"), _text(p % 100)).alias("menu_id"),
        F.when(p % 77 == 0, "x").otherwise(_text(p % restaurants)).alias("r_id"),
        F.concat(F.lit("fd"), _text(p)).alias("f_id"),
        F.col("p_type").alias("cuisine"),
        F.when(p % 50 == 0, "--").otherwise(_text(F.col("p_retailprice").cast("decimal(10,2)"))).alias("price"),
        F.lit(None).cast("string").alias("_source_file"),
        F.lit(None).cast("timestamp").alias("_loaded_at"),
    )


def raw_reviews(table: Source) -> DataFrame:
    """Documents as reviews of orders; odd ones name a restaurant that is not the order's."""
    doc = F.col("doc_id")
    n_orders = table("orders").agg(F.count(F.lit(1)).alias("n")).scalar()
    n_restaurants = table("supplier").agg(F.count(F.lit(1)).alias("n")).scalar()
    first_restaurant = (
        table("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_suppkey").alias("r_id"))
    )
    orders = table("orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("placed_on"))
    # The texts come last, so that they move once and by the review, as its latest version is found.
    numbers = table("documents").select("doc_id", (doc * 7 % n_orders).alias("o_orderkey")).distinct()
    written = numbers.join(orders, "o_orderkey").join(first_restaurant, "o_orderkey", "left")
    return written.join(table("documents").select("doc_id", "text"), "doc_id").select(
        doc.alias("review_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.when(doc % 2 == 0, F.col("r_id")).otherwise(doc % n_restaurants).alias("restaurant_id"),
        (doc % 5 + 1).alias("rating"),
        F.when(doc % 50 != 49, F.col("text")).alias("comment"),
        _day("placed_on", 1).alias("review_date"),
        _file("reviews", _day("placed_on", 1)).alias("_source_file"),
        _day("placed_on", 2).cast("timestamp").alias("_loaded_at"),
    )


def review_enriched(table: Source) -> DataFrame:
    """Labels of some reviews; every tenth review was labelled twice."""
    doc, toxic, quality = F.col("doc_id"), F.col("toxic"), F.col("quality")
    runs = F.when(doc % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    first = F.when(F.col("run") == 0, F.lit("2024-01-01")).otherwise(F.lit("2024-03-01")).cast("date")
    rows = table("labels").select("doc_id", "quality", "toxic", F.explode(runs).alias("run"))
    topics = ("food quality", "delivery", "pricing", "service", "packaging", "other")
    return rows.select(
        doc.alias("review_id"),
        F.when(toxic == 1, "negative").when(quality == 1, "positive").otherwise("neutral").alias("sentiment_label"),
        ((quality - toxic) * F.lit(0.8)).alias("sentiment_score"),
        _pick(topics, doc + F.col("run")).alias("topic"),
        F.when(toxic == 1, "unsafe text").alias("key_issue"),
        F.lit("labels").alias("model"),
        _day(first, (doc % 30).cast("int")).cast("timestamp").alias("enrichment_at"),
    )


def review_embeddings(table: Source) -> DataFrame:
    """One vector per distinct text, that of the lowest document."""
    # Hashed before the join, and picked one by one: who asks for no text moves none.
    texts = table("documents").select(F.col("doc_id").alias("vec_id"), "text", text_hash("text").alias("comment_hash"))
    vectors = table("embeddings").select("vec_id", "embedding")
    known = texts.join(vectors, "vec_id").groupBy("comment_hash")
    return known.agg(F.min_by("text", "vec_id").alias("comment"), F.min_by("embedding", "vec_id").alias("embedding"))

