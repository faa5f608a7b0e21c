"""All registered queries: ``(spark, sf_dir) -> DataFrame`` over the whole test tables."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import cached_property, lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import settings
from orderlake.functions import scalars
from orderlake.operators import quality, upsert, vector_index, versions
from orderlake.plans import checks, daily, labeller, ledger, marts, reports, reviews, staging, upkeep
from orderlake.session import shared_dir, tune
from orderlake.sources import csv_files, tables
from orderlake.sources import sample_tables as sample
from orderlake.sources.schemas import METADATA, TABLES
from orderlake.streaming import ingest as streams


class Lake:
    """The platform's tables as lazy frames over one test directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.source = lru_cache(maxsize=None)(self.source)
        self._written: dict[str, DataFrame] = {}
        self._variants: dict[tuple[str, ...], Lake] = {}

    def source(self, name: str) -> DataFrame:
        return sample.table(self.spark, self.sf_dir, name)

    def raw(self, name: str) -> DataFrame:
        return getattr(self, f"raw_{name}")

    @cached_property
    def raw_restaurants(self) -> DataFrame:
        return sample.raw_restaurants(self.source)

    @cached_property
    def raw_users(self) -> DataFrame:
        return sample.raw_users(self.source)

    @cached_property
    def raw_food(self) -> DataFrame:
        return sample.raw_food(self.source)

    @cached_property
    def raw_menu(self) -> DataFrame:
        return sample.raw_menu(self.source)

    @cached_property
    def raw_orders(self) -> DataFrame:
        return sample.raw_orders(self.source)

    @cached_property
    def raw_order_items(self) -> DataFrame:
        return sample.raw_order_items(self.source)

    @cached_property
    def raw_reviews(self) -> DataFrame:
        return sample.raw_reviews(self.source)

    @cached_property
    def order_times(self) -> DataFrame:
        """Times of all orders from one narrow scan, as the written fact table would give them."""
        return self.source("orders").select(sample.order_timestamp().alias("order_timestamp"))

    @cached_property
    def review_dates(self) -> DataFrame:
        placed = F.col("o_orderdate").cast("date")
        return self.source("orders").select(F.date_add(placed, 1).alias("review_date"))

    def written(self, name: str) -> DataFrame:
        """A table written once, for queries that work on the table and not on its plan."""
        if name not in self._written:
            path = shared_dir(self.spark, name)
            tables.full_refresh(getattr(self, name), path)
            self._written[name] = self.spark.read.parquet(path)
        return self._written[name]

    def on_written(self, *names: str) -> Lake:
        """This lake with some tables written, in this order, so that what builds on them reads them; made once."""
        if names not in self._variants:
            other = self._variants[names] = Lake(self.spark, self.sf_dir)
            for name in names:
                setattr(other, name, other.written(name))
        return self._variants[names]

    @cached_property
    def review_words(self) -> DataFrame:
        return labeller.with_words(self.stg_reviews, "review_id", "rating")

    @cached_property
    def labels(self) -> DataFrame:
        return sample.review_enriched(self.source)

    @cached_property
    def vectors(self) -> DataFrame:
        return sample.review_embeddings(self.source)

    @cached_property
    def vector_index(self) -> vector_index.VectorIndex:
        return vector_index.build(self.vectors, shared_dir(self.spark, "vector_index"))

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw_orders)

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(self.raw("order_items"))

    @cached_property
    def stg_restaurant_versions(self) -> DataFrame:
        return staging.stg_restaurant_versions(self.raw("restaurants"))

    @cached_property
    def stg_restaurants(self) -> DataFrame:
        return staging.stg_restaurants(self.raw("restaurants"))

    @cached_property
    def stg_users(self) -> DataFrame:
        return staging.stg_users(self.raw("users"))

    @cached_property
    def stg_food(self) -> DataFrame:
        return staging.stg_food(self.raw("food"))

    @cached_property
    def stg_menu(self) -> DataFrame:
        return staging.stg_menu(self.raw("menu"))

    @cached_property
    def stg_reviews(self) -> DataFrame:
        return staging.stg_reviews(self.raw_reviews, self.stg_restaurants)

    @cached_property
    def latest_reviews(self) -> DataFrame:
        return staging.latest_reviews(self.raw_reviews)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return marts.dim_customer(self.stg_users)

    @cached_property
    def dim_restaurants(self) -> DataFrame:
        return marts.dim_restaurants(self.stg_restaurants)

    @cached_property
    def dim_food(self) -> DataFrame:
        return marts.dim_food(self.stg_food)

    @cached_property
    def restaurants_history(self) -> DataFrame:
        return marts.dim_restaurants_history(self.stg_restaurant_versions)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return marts.fct_orders(self.stg_orders)

    @cached_property
    def placed_orders(self) -> DataFrame:
        """What items take from their orders."""
        return self.stg_orders.select("order_id", "order_timestamp", "order_date", "city")

    @cached_property
    def fct_order_items(self) -> DataFrame:
        return marts.fct_order_items(self.stg_order_items, self.stg_orders)

    @cached_property
    def fct_orders_point_in_time(self) -> DataFrame:
        return marts.fct_orders_point_in_time(
            self.fct_orders, self.restaurants_history, self.dim_restaurants, span=self.order_times
        )

    @cached_property
    def mart_daily_city_revenue(self) -> DataFrame:
        return marts.mart_daily_city_revenue(self.fct_orders)

    @cached_property
    def mart_restaurant_performance(self) -> DataFrame:
        return marts.mart_restaurant_performance(self.fct_orders, self.dim_restaurants)

    @cached_property
    def mart_delivery_sla(self) -> DataFrame:
        return marts.mart_delivery_sla(self.fct_orders)

    @cached_property
    def mart_restaurant_price_changes(self) -> DataFrame:
        return marts.mart_restaurant_price_changes(
            self.fct_orders, self.restaurants_history, self.dim_restaurants, span=self.order_times
        )

    @cached_property
    def mart_daily_review_stats(self) -> DataFrame:
        return marts.mart_daily_review_stats(self.stg_reviews)

    @cached_property
    def mart_review_insights(self) -> DataFrame:
        return marts.mart_review_insights(self.stg_reviews, self.labels)

    @cached_property
    def latest_enrichment(self) -> DataFrame:
        return marts.latest_enrichment(self.labels)

    @cached_property
    def mart_review_search(self) -> DataFrame:
        latest = self.written("latest_reviews")
        return marts.mart_review_search(
            staging.with_city(latest, self.stg_restaurants), self.restaurants_history, self.fct_orders, self.labels, self.review_dates, latest
        )

    @cached_property
    def review_search_rows(self) -> DataFrame:
        """What a search reads of all reviews; their texts stay in the written latest reviews."""
        latest = staging.with_city(self.written("latest_reviews").drop("comment"), self.stg_restaurants)
        return marts.review_search_rows(latest, self.restaurants_history, self.fct_orders, self.labels, span=self.review_dates)


@lru_cache(maxsize=4)
def _plans(spark: SparkSession, sf_dir: str, files: int) -> Lake:
    return Lake(spark, sf_dir)


def lake_of(spark: SparkSession, sf_dir: str) -> Lake:
    """The lake of a directory; plans and written tables that several queries share are made once per session and state of its files."""
    return _plans(tune(spark), sf_dir, tables.state_of_files(spark, sf_dir))


def forget() -> None:
    """Drop all shared plans and written tables."""
    _plans.cache_clear()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _model(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(lake_of(spark, sf_dir), name)

    run.__name__ = name
    return run


for _name in (
    "stg_orders stg_order_items stg_restaurant_versions stg_restaurants stg_users stg_food stg_menu stg_reviews "
    "dim_customer dim_restaurants dim_food restaurants_history fct_orders fct_order_items fct_orders_point_in_time "
    "mart_daily_city_revenue mart_restaurant_performance mart_delivery_sla mart_restaurant_price_changes "
    "mart_daily_review_stats mart_review_insights latest_enrichment mart_review_search"
).split():
    QUERIES[_name] = _model(_name)


def query(fn: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(lake_of(spark, sf_dir))

    run.__name__ = fn.__name__
    QUERIES[fn.__name__] = run
    return fn


# --- files -------------------------------------------------------------------------------


def _data_columns(df: DataFrame) -> DataFrame:
    return df.drop(*METADATA)


def _yearly(df: DataFrame) -> DataFrame:
    """File rows with a folder day, the last day of their year; undated rows belong to 1900."""
    year = F.coalesce(F.year(scalars.file_date()), F.lit(1900))
    return _data_columns(df.withColumn("dt", F.concat(year.cast("string"), F.lit("-12-31"))))


@query
def csv_scan(lake: Lake) -> DataFrame:
    """Dishes written with NULL tokens and read back by position."""
    drop = shared_dir(lake.spark, "csv_scan")
    token = F.when(F.col("_idx").cast("int") % 2 == 0, "\\N").otherwise("NULL")
    food = _data_columns(lake.raw("food"))
    tables.write_csv_drop(food.withColumn("f_id", F.coalesce("f_id", token)), drop)
    return _data_columns(csv_files.read_table(lake.spark.read, "food", drop))


_AS_IT_IS = {"quoteAll": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _messy_users(lake: Lake) -> str:
    """Users as files of a thousand records each: every user three times, once with a line break and quotes
    inside a field and once with a control character; and three lines per user that are no records."""
    path = shared_dir(lake.spark, "messy_users")
    users = _data_columns(lake.raw("users"))
    name = F.col("name")
    names = {"plain": name, "broken": F.concat(name, F.lit('\na "second" line')), "control": F.concat(F.lit("\u0001"), name)}

    def line(text):
        row = F.struct(*[text.alias(c) if c == "name" else F.col(c) for c in users.columns])
        return F.to_csv(row, _AS_IT_IS)

    open_quote = F.concat(F.lit('1,"'), name, F.lit(" open"))
    beside = [F.concat(F.lit('2,"'), name, F.lit('"x,y')), F.concat(F.lit("3,"), name, F.lit('"z",y'))]
    lines = F.array(open_quote, *[line(text) for text in names.values()], *beside)
    group = F.floor(F.col("_idx").cast("bigint") / 1000).alias("part")
    records = users.select(group, F.array_join(lines, "\n").alias("lines"))
    files = records.groupBy("part").agg(F.array_join(F.collect_list("lines"), "\n").alias("lines"))
    header = F.lit(",".join(users.columns) + "\n")
    files.select("part", F.concat(header, "lines").alias("value")).write.partitionBy("part").text(path)
    return path


@query
def load_tolerant(lake: Lake) -> DataFrame:
    """Users with odd but legal fields among broken lines; only the broken lines are left out."""
    return _data_columns(csv_files.read_table(lake.spark.read, "users", _messy_users(lake)))


@query
def load_rejects(lake: Lake) -> DataFrame:
    """The broken lines of the same files, with the reason."""
    rejects = csv_files.rejected(csv_files.read_records(lake.spark.read, _messy_users(lake)))
    return rejects.groupBy("line", "reason").agg(F.count(F.lit(1)).alias("n"))


@query
def load_strict(lake: Lake) -> DataFrame:
    """Orders with ratings and minutes written like '5.0' load as whole numbers."""
    drop = shared_dir(lake.spark, "load_strict")
    orders = _data_columns(lake.raw_orders)
    decimals = {c: F.col(c).cast("decimal(10,1)").cast("string") for c in ("customer_rating", "delivery_time_min")}
    clock = F.date_format("order_timestamp", "yyyy-MM-dd HH:mm:ss")
    tables.write_csv_drop(orders.withColumns(decimals | {"order_timestamp": clock}), drop)
    return _data_columns(csv_files.read_table(lake.spark.read, "orders", drop))


@query
def load_metadata(lake: Lake) -> DataFrame:
    """Rows per file day, and the number of load times of the one load that read them."""
    drop = shared_dir(lake.spark, "load_metadata")
    tables.write_csv_drop(_yearly(lake.raw("restaurants")), drop, "dt")
    loaded = csv_files.read_table(lake.spark.read, "restaurants", drop)
    return loaded.groupBy(scalars.file_date().alias("file_day")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("_loaded_at").alias("load_times")
    )


@query
def load_day(lake: Lake) -> DataFrame:
    """The restaurant changes of one day's folder."""
    drop = shared_dir(lake.spark, "load_day")
    tables.write_csv_drop(_yearly(lake.raw("restaurants")), f"{drop}/restaurants", "dt")
    return _data_columns(csv_files.load_day(lake.spark, drop, "restaurants", "1996-12-31"))


@query
def load_audit(lake: Lake) -> DataFrame:
    return csv_files.load_audit({name: lake.raw(name) for name in TABLES})


@query
def loaded_at_default(lake: Lake) -> DataFrame:
    return lake.raw("restaurants").select("id", "_source_file", scalars.loaded_at().alias("_loaded_at"))


@query
def incremental_ingest(lake: Lake) -> DataFrame:
    """Two drops of order files loaded by one stream: first versions, then late and re-sent rows.

    The stream runs once more after each drop and finds nothing new.
    """
    path = shared_dir(lake.spark, "incremental_ingest")
    later = scalars.file_date() > F.col("order_date")
    for drop, rows in (("first", lake.raw_orders.where(~later)), ("second", lake.raw_orders.where(later))):
        tables.write_csv_drop(_yearly(rows), f"{path}/orders/{drop}", "dt")
        for _ in range(2):
            load = streams.ingest(lake.spark, "orders", f"{path}/orders", f"{path}/raw", f"{path}/checkpoint")
            load.awaitTermination()
    loaded = lake.spark.read.parquet(f"{path}/raw")
    return loaded.drop(*METADATA, "_load_day", "_load")


# --- written tables ----------------------------------------------------------------------


@query
def full_refresh(lake: Lake) -> DataFrame:
    """A table that is replaced as a whole keeps nothing of its earlier rows."""
    path = shared_dir(lake.spark, "full_refresh")
    tables.full_refresh(lake.dim_restaurants.withColumn("rating", F.lit(None).cast("decimal(3,1)")), path)
    tables.full_refresh(lake.dim_restaurants, path)
    return lake.spark.read.parquet(path)


@query
def write_day_partition(lake: Lake) -> DataFrame:
    """Order counts per day written by day, with the days written twice."""
    path = shared_dir(lake.spark, "write_day_partition")
    days = lake.raw_orders.groupBy(scalars.file_date().alias("dt")).agg(F.count(F.lit(1)).alias("n"))
    monthly = days.select(F.trunc("dt", "month").alias("dt"), F.col("dt").alias("file_day"), "n")
    for _ in range(2):
        tables.overwrite_partitions(monthly, path, ["dt"])
    return lake.spark.read.parquet(path).select(F.col("dt").cast("date").alias("dt"), "file_day", "n")


def _by_month(orders: DataFrame) -> DataFrame:
    return orders.withColumn("order_month", F.year("order_date") * 100 + F.month("order_date"))


@query
def incremental_merge_orders(lake: Lake) -> DataFrame:
    """Orders merged in two loads, the second one twice; equals a rebuild from all rows."""
    path = shared_dir(lake.spark, "merge_orders")
    later = scalars.file_date() > F.col("order_date")
    raw = lake.written("raw_orders")
    for rows in (raw.where(~later), raw.where(later), raw.where(later)):
        updates = _by_month(marts.fct_orders(staging.stg_orders(rows)))
        upsert.upsert(lake.spark, path, updates, "order_id", "order_month")
    return tables.read(lake.spark, path).select(*marts.ORDER_COLUMNS)


@query
def incremental_merge_items(lake: Lake) -> DataFrame:
    """Items merged in order of load; later loads replace and repeat earlier ones."""
    path = shared_dir(lake.spark, "merge_items")
    raw, early = lake.raw("order_items"), F.col("_loaded_at") < F.lit("1998-01-01").cast("timestamp")
    orders = lake.written("placed_orders")
    ties = ["restaurant_id", "f_id", "quantity", "line_amount"]
    for rows in (raw.where(early), raw.where(~early), raw):
        staged = shared_dir(lake.spark, "items")
        slices = daily.items_by_orders(lake.spark, rows, lambda ids: orders, staged)
        updates = (_by_month(marts.fct_order_items(staging.typed_order_items(items), placed)) for items, placed in slices)
        upsert.upsert(lake.spark, path, updates, "order_item_id", "order_month", ties)
        tables.remove(lake.spark, staged)
    return tables.read(lake.spark, path).drop("order_month")


@query
def merge_items_late_order(lake: Lake) -> DataFrame:
    """All items are loaded at once, a third of the orders only later: their items have waited."""
    path = shared_dir(lake.spark, "late_order")
    items, facts, late = lake.raw("order_items"), lake.written("fct_orders"), F.col("order_id") % 3 == 0
    by_month = {"partition_by": "order_month", "with_partition": _by_month}
    for rows, orders in ((items, facts.where(~late)), (items.where("false"), facts.where(late))):
        upsert.upsert(lake.spark, f"{path}/orders", _by_month(orders), "order_id", "order_month")
        daily.merge_items(lake.spark, f"{path}/fct", f"{path}/waiting", rows, f"{path}/orders", **by_month)
    return tables.read(lake.spark, f"{path}/fct").drop("order_month")


def _merged_with_sums(lake: Lake, name: str) -> tuple[str, dict[str, DataFrame], DataFrame | None]:
    """Orders merged in two loads, the second one twice, with the stored sums that follow; and the last load's signed rows."""
    path = shared_dir(lake.spark, name)
    raw, later = lake.written("raw_orders"), scalars.file_date() > F.col("order_date")
    for i, rows in enumerate((raw.where(~later), raw.where(later), raw.where(later))):
        updates = _by_month(marts.fct_orders(staging.stg_orders(rows)))
        signed = f"{path}/changes{i}"
        done = upsert.upsert(lake.spark, f"{path}/fct", updates, "order_id", "order_month", changes=signed)
        changes = None if done is None else lake.spark.read.parquet(signed)
        sums = upkeep.refresh_sums(lake.spark, f"{path}/state", tables.read(lake.spark, f"{path}/fct"), changes)
        if i == 0:
            history, names = lake.restaurants_history, lake.dim_restaurants
            upkeep.refresh_price_changes(lake.spark, f"{path}/prices", sums["restaurant_days"], None, history.where("restaurant_id % 5 <> 0"), names)
    return path, sums, changes


@query
def performance_from_changes(lake: Lake) -> DataFrame:
    """The performance of restaurants from sums to which late and re-sent orders were added and whose old versions were subtracted."""
    return marts.restaurant_performance(_merged_with_sums(lake, "performance_changes")[1]["restaurant_sums"], lake.dim_restaurants)


@query
def delivery_sla_from_counts(lake: Lake) -> DataFrame:
    """Percentiles from stored numbers per city, hour and minute alone."""
    return marts.delivery_sla(_merged_with_sums(lake, "delivery_counts")[1]["delivery_minutes"])


@query
def price_changes_from_changes(lake: Lake) -> DataFrame:
    """The price change mart computed after the first load without a fifth of the restaurants, then brought up to the others and to
    orders that came later."""
    path, sums, _ = _merged_with_sums(lake, "price_changes")
    signed = lake.spark.read.parquet(f"{path}/changes1")
    upkeep.refresh_price_changes(lake.spark, f"{path}/prices", sums["restaurant_days"], signed, lake.restaurants_history, lake.dim_restaurants)
    return tables.read(lake.spark, f"{path}/prices").drop("_changed_month")


@query
def reconcile_from_ledger(lake: Lake) -> DataFrame:
    """Orders of RAW against facts that missed what came late, by sums that followed three loads of RAW."""
    folder, later = shared_dir(lake.spark, "ledger"), scalars.file_date() > F.col("order_date")
    raw, facts = lake.written("raw_orders"), f"{folder}/fct"
    for rows in (raw.where(~later), raw.where(later), raw.where(later)):
        ledger.absorb(lake.spark, folder, ledger.ORDERS, rows)
    upsert.upsert(lake.spark, facts, _by_month(marts.fct_orders(staging.stg_orders(raw.where(~later)))), "order_id", "order_month")
    found = ledger.reconcile(lake.spark, folder, ledger.ORDERS, facts, "order_month")
    both = [f"{side}_{m}" for m in ("orders", "delivered_gmv", "refunded") for side in ("raw", "fct")]
    differs = (F.col("raw_checksum") != F.col("fct_checksum")).alias("rows_differ")
    return found.select(*[F.col(c).cast("bigint").alias(c) for c in both], differs)


@query
def stream_merge_orders(lake: Lake) -> DataFrame:
    """Orders streamed from RAW batches into the fact table."""
    path = shared_dir(lake.spark, "stream_orders")
    later = scalars.file_date() > F.col("order_date")

    def merge(batch: DataFrame) -> None:
        updates = _by_month(marts.fct_orders(staging.stg_orders(batch.drop("_load"))))
        upsert.upsert(lake.spark, f"{path}/fct", updates, "order_id", "order_month")

    for load, rows in (("1", lake.raw_orders.where(~later)), ("2", lake.raw_orders.where(later))):
        tables.overwrite_partitions(rows.withColumn("_load", F.lit(load)), f"{path}/raw", ["_load"])
        streams.follow_raw(lake.spark, f"{path}/raw", merge, f"{path}/checkpoint").awaitTermination()
    return tables.read(lake.spark, f"{path}/fct").select(*marts.ORDER_COLUMNS)


@query
def incremental_lookback(lake: Lake) -> DataFrame:
    """Orders a run re-reads when the facts were last loaded in mid 1998."""
    target = lake.raw_orders.where(F.col("_loaded_at") <= F.lit("1998-07-01").cast("timestamp")).select("_loaded_at")
    return upsert.loaded_since(lake.fct_orders, target)


@query
def append_new_columns(lake: Lake) -> DataFrame:
    """Facts written before and after a column was added."""
    path = shared_dir(lake.spark, "append_new_columns")
    columns = ["order_id", "order_date", "sales_amount"]
    early = F.col("order_date") < F.lit("1998-01-01").cast("date")
    lake.fct_orders.where(early).select(*columns).write.parquet(path)
    lake.fct_orders.where(~early).select(*columns, "payment_method").write.mode("append").parquet(path)
    return tables.read(lake.spark, path)


@query
def scd2_snapshot(lake: Lake) -> DataFrame:
    """Snapshots of the restaurants as known on three dates, the last one taken twice."""
    path = shared_dir(lake.spark, "scd2_snapshot")
    raw = lake.raw("restaurants")
    for day in ("1996-01-01", "1998-01-01", "2030-01-01", "2030-01-02"):
        run_at = F.lit(day).cast("timestamp")
        known = raw.where(F.coalesce("_loaded_at", F.lit("1990-01-01").cast("timestamp")) < run_at)
        daily.apply_snapshot(lake.spark, path, staging.stg_restaurants(known), "restaurant_id", marts.TRACKED, run_at)
    columns = ["restaurant_id", *marts.TRACKED, "dbt_valid_from", "dbt_valid_to"]
    return tables.read(lake.spark, path).select(*columns)


@query
def insert_if_absent(lake: Lake) -> DataFrame:
    """Labels of the first run, then all labels: only reviews without one are added."""
    path = shared_dir(lake.spark, "insert_if_absent")
    first_run = F.col("enrichment_at") < F.lit("2024-01-15").cast("timestamp")
    newest = [F.col("enrichment_at").desc()]
    upsert.insert_if_absent(lake.spark, path, lake.labels.where(first_run), "review_id", newest)
    for _ in range(2):
        upsert.insert_if_absent(lake.spark, path, lake.labels, "review_id", newest)
    return lake.spark.read.parquet(path)


@query
def trace_log_flatten(lake: Lake) -> DataFrame:
    """JSON traces of events, appended to a log and summed per event type and field."""
    path = shared_dir(lake.spark, "trace_log")
    reports.append_traces(lake.source("events").select("event_id", "event_type", "props"), path, "props")
    fields = reports.trace_fields(lake.spark.read.parquet(path), "props", ["event_type"])
    return fields.groupBy("event_type", "key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value_number").alias("total"), F.min("value_text").alias("first_text")
    )


# --- expressions -------------------------------------------------------------------------


@query
def scalar_functions(lake: Lake) -> DataFrame:
    """Every scalar expression of the plans over the restaurant files."""
    day, number = scalars.file_date(), scalars.first_whole("cost")
    rating = scalars.try_amount("rating", 3, 1)
    texts = [number.cast("string"), scalars.first_whole("rating_count").cast("string")]
    vector = scalars.vector_from_json(F.concat(F.lit("["), F.concat_ws(",", *texts), F.lit("]")), 2)
    return lake.raw("restaurants").select(
        "_idx",
        "name",
        scalars.try_whole("id").alias("id_number"),
        rating.alias("rating"),
        number.alias("cost"),
        scalars.first_whole("rating_count").alias("rating_count"),
        scalars.city_of("city").alias("city"),
        day.alias("file_day"),
        scalars.loaded_at().alias("loaded_at"),
        scalars.text_hash("link").alias("link_hash"),
        F.lower("name").alias("name_lower"),
        F.initcap(F.lower("cuisine")).alias("cuisine_title"),
        scalars.mask_email(F.concat(F.col("name"), F.lit("@x.org"))).alias("masked"),
        F.concat(F.col("lic_no"), F.lit("-"), F.date_format(day, "yyyyMMdd")).alias("version_key"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.monthname(day).alias("month_name"),
        F.dayname(day).alias("day_name"),
        (F.weekday(day) + 1).alias("iso_day"),
        F.hour(F.col("_loaded_at")).alias("load_hour"),
        F.date_add(day, -7).alias("week_before"),
        scalars.days_between(day, F.lit("2000-01-01").cast("date")).alias("days_to_2000"),
        scalars.strict_greatest(number, rating.cast("bigint")).alias("greatest"),
        scalars.strict_least(number, rating.cast("bigint")).alias("least"),
        scalars.ratio(number, number % 100, 3).alias("ratio"),
        F.abs(number - 300).alias("distance"),
        scalars.dot(vector, vector).alias("vector_square"),
    )


@query
def mask_email(lake: Lake) -> DataFrame:
    return marts.dim_customer(lake.stg_users, pii_masking=True).select("customer_id", "email")


@query
def analyst_projection(lake: Lake) -> DataFrame:
    return marts.analyst_projection(lake.dim_customer)


@query
def dim_date(lake: Lake) -> DataFrame:
    """The calendar of all days between the first and the last order, with the orders of each day."""
    bounds = lake.raw_orders.agg(F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day"))
    orders = lake.fct_orders.groupBy(F.col("order_date").alias("date_day")).agg(F.count(F.lit(1)).alias("n"))
    days = marts.calendar(marts.date_spine(bounds)).join(orders, "date_day", "left")
    return days.withColumn("orders", F.coalesce("n", F.lit(0))).drop("n")


@query
def dedup_latest_items(lake: Lake) -> DataFrame:
    keys = ["order_id", "r_id"]
    return versions.dedup_latest(lake.raw("order_items"), keys, ["order_item_id", "f_id", "quantity", "line_amount"])


@query
def dedup_latest(lake: Lake) -> DataFrame:
    return versions.dedup_latest(lake.raw_orders, "order_id").select("order_id", "order_status", *METADATA)


# --- reviews -----------------------------------------------------------------------------


@query
def review_filter(lake: Lake) -> DataFrame:
    args = reviews.ReviewQuery(
        city="nation_3", date_from="1995-06-01", date_to="2000-12-31", sentiment="negative", max_restaurant_rating=4.5
    )
    return reviews.review_filter(lake.review_search_rows, args)


def _question(lake: Lake):
    """The vector of the lowest document stands for the embedded question."""
    vectors = lake.source("embeddings")
    return vectors.agg(F.min_by("embedding", "vec_id").alias("v")).scalar()


@query
def review_search(lake: Lake) -> DataFrame:
    return _found(lake).drop("score")


@query
def review_search_indexed(lake: Lake) -> DataFrame:
    """The same through the partitioned index, which is built once for the tables' state."""
    args = reviews.ReviewQuery(query="late delivery", sentiment="negative", k=10)
    question = lake.source("embeddings").agg(F.min_by("embedding", "vec_id").alias("v")).head().v
    rows, texts = lake.written("review_search_rows"), lake.written("latest_reviews")
    return reviews.review_search(rows, lake.vector_index, list(question), args, texts=texts).drop("score")


def _found(lake: Lake) -> DataFrame:
    args = reviews.ReviewQuery(query="late delivery", sentiment="negative", k=10)
    rows, texts = lake.written("review_search_rows"), lake.written("latest_reviews")
    return reviews.review_search(rows, lake.vectors, _question(lake), args, texts=texts)


@query
def review_search_results(lake: Lake) -> DataFrame:
    """One row per text; its array of examples is shown as lists of their ids and cities."""
    found = reviews.search_results(_found(lake))
    examples = [F.array_join(F.col(f"examples.{c}").cast("array<string>"), ",").alias(f"example_{c}") for c in ("review_id", "city")]
    return found.select("text", "reviews", "similarity", *examples)


@query
def review_search_summary(lake: Lake) -> DataFrame:
    args = reviews.ReviewQuery(topic="delivery", date_from="1996-01-01")
    return reviews.search_summary(lake.review_search_rows, lake.vectors, args)


@query
def reviews_to_enrich(lake: Lake) -> DataFrame:
    return reviews.reviews_to_enrich(lake.stg_reviews, lake.labels)


@query
def next_reviews_to_enrich(lake: Lake) -> DataFrame:
    """The batch of one run; the cap is the feature."""
    return reviews.reviews_to_enrich(lake.stg_reviews, lake.labels, settings.REVIEWS_PER_RUN)


@query
def enrich_reviews(lake: Lake) -> DataFrame:
    return reviews.rule_labels(lake.stg_reviews)


#: Words of the test data's languages that stand for words which name a topic.
LANGUAGE_ANCHORS = {"food quality": ("the", "and"), "delivery": ("der", "und"), "pricing": ("les", "des"), "service": ("que", "los")}


@query
def learned_labels(lake: Lake) -> DataFrame:
    """What the stars of all reviews teach about words: raw scores, worst words, and topics that grow from a few anchors."""
    words = lake.written("review_words")
    values = labeller.word_values(labeller.word_counts(words, LANGUAGE_ANCHORS), LANGUAGE_ANCHORS)
    joined = words.select("review_id").join(labeller.judged(words, values, LANGUAGE_ANCHORS), "review_id", "left")
    return joined.select("review_id", F.round("raw", 6).alias("raw"), "key_issue", F.coalesce("topic", F.lit("other")).alias("topic"))


@query
def model_labels(lake: Lake) -> DataFrame:
    """All reviews through a labelling function in the tasks; bad answers carry their problem.

    The function stands in for a model and looks at the length of the whole text only.
    """
    # Plain values, so that executors need not have this package.
    sentiments, topics = list(settings.SENTIMENTS), [*settings.TOPICS, "weather"]

    def labeller(comment: str) -> str:
        n = len(comment)
        if n % 11 == 10:
            raise TimeoutError("no reply")
        if n % 13 == 12:
            return "sorry"
        labels = {"sentiment_label": sentiments[n % 3], "sentiment_score": (n % 5 - 2) / 2, "topic": topics[n % 7]}
        return json.dumps(labels | {"key_issue": "null" if n % 2 else f"length {n}"})

    answers = reviews.model_answers(lake.stg_reviews, labeller)
    return reviews.checked_answers(answers, "length").drop("answer")


@query
def encode_texts(lake: Lake) -> DataFrame:
    """All distinct texts through an encoder function in the tasks, in requests of 64."""

    def encoder(texts: list[str]) -> list[list[float]]:
        return [[len(t), t.count(" ") + 1] for t in texts]

    vectors = reviews.encoded_vectors(reviews.texts_to_embed(lake.stg_reviews, None), encoder, "length")
    parts = [F.col("embedding")[i].cast("double").alias(name) for i, name in enumerate("xy")]
    return vectors.select("comment_hash", "model", F.size("embedding").alias("dimension"), *parts)


@query
def texts_to_embed(lake: Lake) -> DataFrame:
    return reviews.texts_to_embed(lake.stg_reviews, lake.vectors)


@query
def embed_texts(lake: Lake) -> DataFrame:
    """Every text's vector, without its zeros."""
    vectors = reviews.hashed_vectors(reviews.texts_to_embed(lake.stg_reviews, None))
    places = vectors.select(
        "comment_hash", F.posexplode("embedding").alias("place", "weight"), "model", F.size("embedding").alias("dimensions")
    )
    return places.where("weight <> 0").withColumn("weight", F.col("weight").cast("double"))


# --- profile and reports -----------------------------------------------------------------


@query
def latest_dates(lake: Lake) -> DataFrame:
    return reports.latest_dates(lake.fct_orders, lake.mart_daily_review_stats)


@query
def categorical_values(lake: Lake) -> DataFrame:
    return reports.categorical_values(
        {
            "fct_orders": (lake.fct_orders, ["order_status", "payment_method"]),
            "dim_customer": (lake.dim_customer, ["age_segment"]),
            "dim_food": (lake.dim_food, ["veg_or_non_veg"]),
            "mart_review_insights": (lake.mart_review_insights, ["sentiment_label", "topic"]),
        }
    )


@query
def top_cities(lake: Lake) -> DataFrame:
    return reports.top_cities(lake.mart_daily_city_revenue)


@query
def late_arrivals(lake: Lake) -> DataFrame:
    return reports.late_arrivals(lake.raw_orders)


@query
def status_changes(lake: Lake) -> DataFrame:
    return reports.status_changes(lake.raw_orders)


@query
def amount_consistency(lake: Lake) -> DataFrame:
    return reports.amount_consistency(lake.fct_orders, lake.fct_order_items)


@query
def anomaly_days(lake: Lake) -> DataFrame:
    return reports.anomaly_days(lake.fct_orders, lake.stg_reviews)


@query
def daily_feed_summary(lake: Lake) -> DataFrame:
    return reports.daily_feed_summary(
        lake.raw_orders, lake.raw("order_items"), lake.raw_reviews, lake.raw("restaurants")
    )


@query
def review_eligibility(lake: Lake) -> DataFrame:
    return reports.review_eligibility(lake.stg_reviews, lake.raw_orders)


# --- checks ------------------------------------------------------------------------------


@query
def dq_unique(lake: Lake) -> DataFrame:
    return quality.duplicates(lake.raw("order_items"), "order_item_id")


@query
def dq_not_null(lake: Lake) -> DataFrame:
    return quality.missing(lake.fct_orders_point_in_time, "restaurant_version_key")


@query
def dq_relationships(lake: Lake) -> DataFrame:
    return quality.orphans(lake.fct_orders, "customer_id", lake.dim_customer, "customer_id")


@query
def dq_accepted_values(lake: Lake) -> DataFrame:
    return quality.unexpected_values(lake.raw("food"), "veg_or_non_veg", ["Veg", "Non-veg"])


@query
def dq_report(lake: Lake) -> DataFrame:
    """All checks; tables that several of them read are written once each, as a run of the platform has them."""
    names = "stg_restaurants stg_orders latest_reviews restaurants_history".split()
    stored = lake.on_written(*names)
    stored.stg_reviews = staging.with_city(stored.latest_reviews, stored.stg_restaurants)
    return checks.full_report(stored)


@query
def reconcile_orders(lake: Lake) -> DataFrame:
    return checks.reconcile_orders(lake.raw_orders, lake.fct_orders)


@query
def reconcile_orders_without_late(lake: Lake) -> DataFrame:
    """Facts that missed late and re-sent rows do not reconcile."""
    on_time = lake.raw_orders.where(scalars.file_date() == F.col("order_date"))
    return checks.reconcile_orders(lake.raw_orders, marts.fct_orders(staging.stg_orders(on_time)))


@query
def reconcile_order_items(lake: Lake) -> DataFrame:
    return checks.reconcile_order_items(lake.raw("order_items"), lake.raw_orders, lake.fct_order_items)


@query
def reconcile_items_without_late(lake: Lake) -> DataFrame:
    on_time = lake.raw_orders.where(scalars.file_date() == F.col("order_date"))
    items = marts.fct_order_items(lake.stg_order_items, staging.stg_orders(on_time))
    return checks.reconcile_order_items(lake.raw("order_items"), lake.raw_orders, items)


@query
def assert_history_current(lake: Lake) -> DataFrame:
    return checks.history_current(lake.restaurants_history, lake.stg_restaurants)


@query
def history_current_broken(lake: Lake) -> DataFrame:
    """A history with no, several and the right number of current versions, and restaurants that are missing."""
    third = F.col("restaurant_id") % 3
    current = F.when(third == 0, False).when(third == 1, True).otherwise(F.col("is_current"))
    history = lake.restaurants_history.withColumn("is_current", current)
    return checks.history_current(history, lake.stg_restaurants.where("restaurant_id % 7 <> 0"))
