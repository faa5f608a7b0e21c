"""One logical day: load the files, refresh facts and marts, label and embed new reviews."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import settings
from orderlake.operators import deltas, slices
from orderlake.operators import upsert as incremental
from orderlake.operators.versions import scd2_snapshot
from orderlake.plans import checks, ledger, marts, reviews, staging, upkeep
from orderlake.plans.labeller import learn
from orderlake.session import shared_dir, tune
from orderlake.sources import tables
from orderlake.sources.schemas import TABLES
from orderlake.streaming.ingest import ingest_day

#: The labeller that learns from the reviews' own stars.
LEARNED = "learned"

LABEL_SCHEMA = (
    "review_id bigint, sentiment_label string, sentiment_score double, topic string, key_issue string, model string, "
    "enrichment_at timestamp"
)


class Warehouse:
    """The written tables below one folder; staging and views stay lazy."""

    def __init__(self, spark: SparkSession, path: str, pii_masking: bool = False):
        self.spark, self.path, self.pii_masking = tune(spark), path.rstrip("/"), pii_masking

    def location(self, layer: str, name: str) -> str:
        return f"{self.path}/{layer}/{name}"

    def written(self, layer: str, name: str) -> DataFrame | None:
        path = self.location(layer, name)
        return tables.read(self.spark, path) if tables.exists(self.spark, path) else None

    def raw(self, name: str) -> DataFrame:
        path, schema = self.location("raw", name), TABLES[name].stored_schema
        return self.spark.read.schema(schema).parquet(path) if tables.exists(self.spark, path) else self._empty(schema)

    def rejects(self, name: str) -> DataFrame | None:
        """Lines of a tolerant table's files that were no records, with the reason."""
        return self.written("raw", f"{name}__rejects")

    def _empty(self, schema) -> DataFrame:
        return self.spark.createDataFrame([], schema)

    def mart(self, name: str) -> DataFrame:
        return tables.read(self.spark, self.location("marts", name))

    @property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw("orders"))

    @property
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(self.raw("order_items"))

    @property
    def stg_restaurant_versions(self) -> DataFrame:
        return staging.stg_restaurant_versions(self.raw("restaurants"))

    @property
    def stg_restaurants(self) -> DataFrame:
        return staging.stg_restaurants(self.raw("restaurants"))

    @property
    def stg_users(self) -> DataFrame:
        return staging.stg_users(self.raw("users"))

    @property
    def stg_food(self) -> DataFrame:
        return staging.stg_food(self.raw("food"))

    @property
    def stg_menu(self) -> DataFrame:
        return staging.stg_menu(self.raw("menu"))

    @property
    def stg_reviews(self) -> DataFrame:
        """Latest reviews with the restaurant's city of today; the written rows hold all but the city."""
        latest = self.written("staging", "latest_reviews")
        if latest is None:
            return staging.stg_reviews(self.raw("reviews"), self.stg_restaurants)
        cities = self.mart("dim_restaurants") if tables.exists(self.spark, self.location("marts", "dim_restaurants")) else self.stg_restaurants
        return staging.with_city(latest, cities)

    @property
    def fct_orders(self) -> DataFrame:
        found = self.written("marts", "fct_orders")
        return self._empty(marts.fct_orders(self.stg_orders).schema) if found is None else found

    @property
    def fct_order_items(self) -> DataFrame:
        found = self.written("marts", "fct_order_items")
        if found is None:
            return self._empty(marts.fct_order_items(self.stg_order_items, self.stg_orders).schema)
        return found

    @property
    def restaurants_history(self) -> DataFrame:
        return self.mart("dim_restaurants_history")

    @property
    def fct_orders_point_in_time(self) -> DataFrame:
        return marts.fct_orders_point_in_time(self.fct_orders, self.restaurants_history, self.mart("dim_restaurants"))

    @property
    def dim_customer(self) -> DataFrame:
        return self.mart("dim_customer")

    @property
    def mart_review_search(self) -> DataFrame:
        return self.mart("mart_review_search")

    @property
    def labels(self) -> DataFrame:
        found = self.written("ai", "review_enriched")
        return self._empty(LABEL_SCHEMA) if found is None else found


def refresh_orders(
    w: Warehouse, days: int = settings.LOOKBACK_DAYS, fixed_partition: bool = False, changes: str | None = None
) -> set | None:
    """Merge recently loaded orders: only their RAW rows and the day partitions they touch are read.

    The merge compares versions with the rows already there, so an old day that was loaded again
    does not replace anything, exactly as if all of RAW had been ranked. ``fixed_partition`` is
    for feeds in which an order never changes its date. Returns the days that changed, None for all.
    """
    recent = incremental.recent_raw(w.raw("orders"), w.written("marts", "fct_orders"), days)
    updates = marts.fct_orders(staging.stg_orders(recent))
    path = w.location("marts", "fct_orders")
    return incremental.upsert(
        w.spark, path, updates, "order_id", "order_date", fixed_partition=fixed_partition, changes=changes
    )


def items_by_orders(
    spark: SparkSession, raw_items: DataFrame, orders: Callable[[DataFrame], DataFrame], staged: str
) -> Iterator[tuple[DataFrame, DataFrame]]:
    """The latest RAW row of each item, with what items take from their orders, in slices below ``staged`` that have all of an order.

    ``orders`` gets the order ids of the items and gives their orders, and more. Versions are compared in slices of items, of which each
    goes before the next. A slice is there until the next one is asked for.
    """
    n = slices.number_for(raw_items.count())
    latest, placed = slices.Sliced(spark, f"{staged}/latest"), slices.Sliced(spark, f"{staged}/orders")
    order_of = slices.by_hash(F.col("order_id"), n)
    if n == 1:
        latest.add(staging.latest_order_items(raw_items), order_of)
    else:
        raw = slices.Sliced(spark, f"{staged}/raw")
        raw.add(raw_items, slices.by_hash(F.col("order_item_id"), n))
        for i in range(n):
            latest.add(staging.latest_order_items(raw.slice(i)), order_of)
            raw.drop(i)
    ids = latest.all().select("order_id")
    columns = ["order_id", "order_timestamp", "order_date", "city"]
    found = orders(ids).select(F.col("order_id").cast(ids.schema["order_id"].dataType).alias("order_id"), *columns[1:])
    if n > 1:
        placed.add(found, order_of)
    for i in range(n):
        yield latest.slice(i), found if n == 1 else placed.slice(i)
        latest.drop(i)
        placed.drop(i)


def merge_items(
    spark: SparkSession,
    path: str,
    waiting: str,
    raw_items: DataFrame,
    orders: str,
    fixed_partition: bool = False,
    partition_by: str = "order_date",
    with_partition: Callable[[DataFrame], DataFrame] = lambda facts: facts,
) -> None:
    """Merge RAW items of known orders; items whose order is unknown wait for a later run.

    ``orders`` is the path of the orders' facts. Only the partitions are read in which the items' orders are by the index of that table.
    ``with_partition`` adds the partition column where the facts don't have it.

    ``waiting`` is a table of their latest RAW rows. It is looked at in each run, so an item that
    came long before its order is merged when the order comes.
    """
    columns = [c for c in raw_items.columns if not c.startswith("_load_") and c != "_load"]
    todo = raw_items.select(*columns)
    if tables.exists(spark, waiting):
        todo = todo.unionByName(tables.read(spark, waiting))
    staged = shared_dir(spark, "items")
    still = slices.Sliced(spark, f"{staged}/waiting")

    def updates() -> Iterator[DataFrame]:
        def orders_of(ids: DataFrame) -> DataFrame:
            return incremental.rows_of_keys(spark, orders, ids, "order_id", partition_by)

        for items, placed in items_by_orders(spark, todo, orders_of, staged):
            yield with_partition(marts.fct_order_items(staging.typed_order_items(items), placed))
            unknown = items.join(placed.select("order_id"), "order_id", "left_anti")
            still.add(unknown.select(*columns), F.lit(0))

    try:
        incremental.upsert(spark, path, updates(), "order_item_id", partition_by, fixed_partition=fixed_partition)
        tables.full_refresh(still.slice(0), waiting)
    finally:
        tables.remove(spark, staged)


def refresh_order_items(w: Warehouse, days: int = settings.LOOKBACK_DAYS, fixed_partition: bool = False) -> None:
    """Merge recently loaded items, and earlier ones that have waited for their order."""
    recent = incremental.recent_raw(w.raw("order_items"), w.written("marts", "fct_order_items"), days)
    path, waiting = w.location("marts", "fct_order_items"), w.location("staging", "items_without_order")
    orders = w.location("marts", "fct_orders")
    if tables.exists(w.spark, orders):
        merge_items(w.spark, path, waiting, recent, orders, fixed_partition)


def refresh_reviews(w: Warehouse, days: int = settings.LOOKBACK_DAYS) -> None:
    """Merge recently loaded reviews into their written latest versions.

    A review belongs to the day it was written, but a re-send may change that, so moved keys are
    looked for.
    """
    path = w.location("staging", "latest_reviews")
    recent = incremental.recent_raw(w.raw("reviews"), w.written("staging", "latest_reviews"), days)
    updates = staging.latest_reviews(recent)
    incremental.upsert(w.spark, path, updates, "review_id", "review_date", ["rating", "comment"])


def apply_snapshot(
    spark: SparkSession, path: str, current: DataFrame, key: str, tracked: list[str], run_at: Column
) -> None:
    """Run a snapshot against its written history.

    Open versions live in one partition and closed ones in a partition per closing day, so a run
    rewrites the open versions and the closing day only, in one job.
    """
    history = tables.read(spark, path) if tables.exists(spark, path) else None
    closing_day = F.date_format(run_at, "yyyy-MM-dd")
    opened = None if history is None else history.where("_closed_on = 'open'").drop("_closed_on")
    after = scd2_snapshot(opened, current, key, tracked, run_at).withColumn(
        "_closed_on", F.when(F.col("dbt_valid_to").isNull(), "open").otherwise(closing_day)
    )
    if history is not None:
        closed_today = history.where(F.col("_closed_on") == closing_day)
        after = after.unionByName(closed_today, allowMissingColumns=True)
    tables.overwrite_partitions(after, path, ["_closed_on"])


def refresh_days(w: Warehouse, name: str, rows_of: Callable[[DataFrame], DataFrame], facts: DataFrame, day: str, days: set | None) -> None:
    """Rebuild a mart with a row per day and more for the days whose facts changed; all of it where ``days`` is None."""
    path = w.location("marts", name)
    if days is None or not tables.exists(w.spark, path):
        tables.full_refresh(rows_of(facts), path, [day])
    elif days:
        changed = rows_of(facts.where(incremental.in_partitions(day, days)))
        left = {row[0] for row in changed.select(day).distinct().collect()}  # some of the days of a change set
        tables.overwrite_partitions(changed, path, [day])
        tables.drop_partitions(w.spark, path, day, days - left)


def build_core(w: Warehouse, run_at: Column, fixed_dates: bool = False) -> None:
    """Facts, dimensions, history, snapshot and the marts that need no labels."""
    # There from before the merge until the marts of orders have followed it. A run that finds it can't know what the lost run's merge
    # changed: a repeated merge no longer sees what was there before.
    unfinished = w.location("marts", "mart_daily_city_revenue__unfinished")
    left_over = tables.is_marked(w.spark, unfinished)
    tables.mark(w.spark, unfinished)
    signed = shared_dir(w.spark, "order_changes")
    try:
        days = refresh_orders(w, fixed_partition=fixed_dates, changes=signed)
        refresh_order_items(w, fixed_partition=fixed_dates)
        refresh_reviews(w)
        restaurants, orders = w.stg_restaurants, w.fct_orders
        apply_snapshot(
            w.spark, w.location("snapshots", "restaurants"), restaurants, "restaurant_id", marts.TRACKED, run_at
        )

        def save(name: str, df: DataFrame) -> None:
            tables.full_refresh(df, w.location("marts", name))

        save("dim_customer", marts.dim_customer(w.stg_users, w.pii_masking))
        save("dim_restaurants", marts.dim_restaurants(restaurants))
        save("dim_food", marts.dim_food(w.stg_food))
        save("dim_date", marts.dim_date(w.spark))
        save("dim_restaurants_history", marts.dim_restaurants_history(w.stg_restaurant_versions))
        days = None if left_over else days
        changes = None if days is None else w.spark.read.parquet(signed) if days else deltas.signed(orders.limit(0))
        refresh_days(w, "mart_daily_city_revenue", marts.mart_daily_city_revenue, orders, "order_date", days)
        sums = upkeep.refresh_sums(w.spark, w.location("state", "orders"), orders, changes)
        save("mart_restaurant_performance", marts.restaurant_performance(sums["restaurant_sums"], w.mart("dim_restaurants")))
        save("mart_delivery_sla", marts.delivery_sla(sums["delivery_minutes"]))
        path, daily = w.location("marts", "mart_restaurant_price_changes"), sums["restaurant_days"]
        upkeep.refresh_price_changes(w.spark, path, daily, changes, w.restaurants_history, w.mart("dim_restaurants"))
        tables.remove(w.spark, unfinished)
    finally:
        tables.remove(w.spark, signed)
    save("mart_daily_review_stats", marts.mart_daily_review_stats(w.stg_reviews))


def enrich(
    w: Warehouse, labeller: Callable[[str], str] | str | None, model: str, run_at: Column, limit: int | None
) -> None:
    """Label reviews that have no label; answers that cannot be used are kept apart and retried.

    ``labeller`` None takes the word lists, ``LEARNED`` what the reviews' own stars teach.
    """
    todo = reviews.reviews_to_enrich(w.stg_reviews, w.labels, limit, w.written("ai", "quarantine"))
    path = w.location("ai", "review_enriched")
    if labeller is None:
        labels = reviews.rule_labels(todo)
    elif labeller == LEARNED:
        # The words' tables are small beside the reviews, but learning reads all of those once.
        stars = w.stg_reviews.select("review_id", "rating", "comment")
        labels = learn(stars).labels(todo)
    else:
        # Written once, so that good and bad answers come from the same calls.
        asked = w.location("ai", "answers")
        tables.full_refresh(reviews.checked_answers(reviews.model_answers(todo, labeller), model), asked)
        checked = w.spark.read.parquet(asked)
        reviews.quarantine(checked).withColumn("asked_at", run_at).write.mode("append").parquet(
            w.location("ai", "quarantine")
        )
        labels = reviews.good_answers(checked)
    incremental.insert_if_absent(w.spark, path, labels.withColumn("enrichment_at", run_at), "review_id")


def embed(w: Warehouse, encoder, model: str, run_at: Column, limit: int | None) -> None:
    """Vectors for texts that have none of this model; ``encoder`` None uses hashed words. A fitted one (``encoder.fit``) is a function
    like any other; keep it with its model's name, since another fit has another space.

    All vectors of a model have one length; a run that brings another one is refused as a whole.
    """
    path, spark = w.location("ai", "review_embeddings"), w.spark
    known = w.written("ai", "review_embeddings")
    mine = None if known is None else known.where(F.col("model") == model)
    todo = reviews.texts_to_embed(w.stg_reviews, mine, limit)
    found = reviews.hashed_vectors(todo, model=model) if encoder is None else reviews.encoded_vectors(todo, encoder, model)
    staged = shared_dir(spark, "vectors")
    try:
        tables.full_refresh(found.withColumn("embedded_at", run_at), staged)
        new = spark.read.parquet(staged)
        lengths = reviews.vector_lengths(new)
        expected = w.written("ai", "vector_models")
        before = {} if expected is None else {r.model: r.dimensions for r in expected.collect()}
        changed = {m: (before[m], n) for m, n in lengths.items() if before.get(m, n) != n}
        if changed:
            raise ValueError(f"vectors of another length than before: {changed}")
        unknown = [(m, n) for m, n in lengths.items() if m not in before]
        if unknown:
            spark.createDataFrame(unknown, "model string, dimensions int").write.mode("append").parquet(
                w.location("ai", "vector_models")
            )
        # Texts with a vector of this model were left out above.
        new.write.mode("append").parquet(path)
    finally:
        tables.remove(spark, staged)


def build_review_marts(w: Warehouse) -> None:
    insights = marts.mart_review_insights(w.stg_reviews, w.labels)
    tables.full_refresh(insights, w.location("marts", "mart_review_insights"))
    search = marts.mart_review_search(w.stg_reviews, w.restaurants_history, w.fct_orders, w.labels)
    tables.full_refresh(search, w.location("marts", "mart_review_search"))


VIEWS = (
    "stg_orders stg_order_items stg_restaurant_versions stg_restaurants stg_users stg_food stg_menu stg_reviews "
    "fct_orders fct_order_items fct_orders_point_in_time"
).split()
MARTS = (
    "dim_customer dim_restaurants dim_food dim_date dim_restaurants_history mart_daily_city_revenue "
    "mart_restaurant_performance mart_delivery_sla mart_restaurant_price_changes mart_daily_review_stats "
    "mart_review_insights mart_review_search"
).split()


def register_views(w: Warehouse, for_analysts: bool = False) -> list[str]:
    """Make the tables known to ``spark.sql`` by name.

    Analysts get the facts, dimensions and marts without personal and technical columns, and no
    staging rows.
    """
    frames = {name: w.mart(name) for name in MARTS} | {
        name: getattr(w, name) for name in VIEWS if not (for_analysts and name.startswith("stg_"))
    }
    for name, df in frames.items():
        (marts.analyst_projection(df) if for_analysts else df).createOrReplaceTempView(name)
    return sorted(frames)


def quality_report(w: Warehouse, whole: bool = False) -> DataFrame:
    """All checks, reconciliations included; those follow what has changed, or rank all of RAW with ``whole``."""
    raw_orders, raw_items = w.raw("orders"), w.raw("order_items")
    if whole:
        orders = checks.reconcile_orders(raw_orders, w.fct_orders)
        items = checks.reconcile_order_items(raw_items, raw_orders, w.fct_order_items)
    else:
        folder = w.location("state", "ledger")
        ledger.advance(w.spark, folder, raw_orders, raw_items)
        orders = ledger.reconcile(w.spark, folder, ledger.ORDERS, w.location("marts", "fct_orders"))
        items = ledger.reconcile(w.spark, folder, ledger.ITEMS, w.location("marts", "fct_order_items"))
    extra = [
        ("reconcile_orders", orders),
        ("reconcile_order_items", items),
        ("history_current", checks.history_current(w.restaurants_history, w.stg_restaurants)),
    ]
    report = checks.full_report(w)
    for name, failing in extra:
        report = report.unionByName(checks.with_status(checks.counted(name, "error", failing)))
    return report


def run_day(
    spark: SparkSession,
    lake: str,
    warehouse: str,
    ds: str,
    run_at: Column | None = None,
    labeller: Callable[[str], str] | str | None = None,
    encoder=None,
    model: str = settings.RULES_MODEL,
    encoder_model: str = settings.HASHED_MODEL,
    review_limit: int | None = None,
    text_limit: int | None = None,
    pii_masking: bool = False,
    fixed_dates: bool = False,
) -> DataFrame:
    """Run one logical day and return the quality report. Days run one after another, in order.

    A repeated day loads no file twice and leaves every table as it was. ``fixed_dates`` promises
    that an order keeps its date when it is sent again. ``model`` names the labeller and
    ``encoder_model`` the encoder; all open reviews and texts are worked on unless a limit is given.
    """
    run_at = F.current_timestamp() if run_at is None else run_at
    w = Warehouse(spark, warehouse, pii_masking)
    for table in TABLES:
        ingest_day(spark, lake, table, ds, w.path)
    build_core(w, run_at, fixed_dates)
    enrich(w, labeller, model, run_at, review_limit)
    embed(w, encoder, encoder_model, run_at, text_limit)
    build_review_marts(w)
    return quality_report(w)
