"""Marts and reconciliation that follow changes: the same as a rebuild after any series of loads."""

import random

import pytest
from helpers import day, rows, source, ts
from pyspark.sql import functions as F

from orderlake.operators import deltas, upsert
from orderlake.plans import checks, daily, ledger, marts, upkeep
from orderlake.sources import tables
from orderlake.sources.schemas import TABLES

ORDERS = "order_id long, order_timestamp timestamp_ntz, order_date date, user_id long, r_id long, restaurant_city string, cuisine string, items_count long, sales_qty long, subtotal long, discount long, delivery_fee long, gst long, sales_amount long, currency string, payment_method string, order_status string, customer_rating long, delivery_time_min long, _source_file string, _loaded_at timestamp, _load_day date, _load string"
ITEMS = "order_item_id long, order_id long, r_id long, f_id string, price long, quantity long, line_amount long, _source_file string, _loaded_at timestamp, _load_day date, _load string"


def raw_order(rng, load):
    i, d = rng.randrange(1, 25), rng.randrange(1, 9)
    status = rng.choice(["Delivered", "Delivered", "Refunded", "Cancelled"])
    amount = rng.choice([None, 100, 250, 999])
    placed = f"2026-09-{d:02d}T{rng.randrange(10, 14)}:00:00"
    meta = source("orders", f"2026-09-{rng.randrange(d, 10):02d}"), ts(f"2026-09-{10 + load}T00:00:00"), day(f"2026-09-{10 + load}"), f"l{load}"
    city, rating = rng.choice([["Pune", None], ["A,Delhi", 4], ["Delhi", 5]])
    return (i, ts(placed), day(placed[:10]), 1, rng.randrange(1, 5), city, "x", 1, 1, 1, 0, 1, 1, amount, "INR", "UPI", status, rating, rng.choice([None, 20, 30, 31]), *meta)


def raw_item(rng, load):
    amount = rng.randrange(1, 9) * 10
    meta = source("order_items", f"2026-09-{rng.randrange(1, 10):02d}"), ts(f"2026-09-{10 + load}T00:00:00"), day(f"2026-09-{10 + load}"), f"l{load}"
    i = rng.randrange(1, 40)
    return (i, i % 34 + 1, 1, "f", amount, 1, amount, *meta)


def versions(spark, load):
    """The restaurants' history, whose prices and names change while the loads go on."""
    data = [(r, day("2026-09-01"), 100 * r) for r in range(1, 5)] + [(r, day(f"2026-09-0{2 + (r + k) % 6}"), 100 * r + 7 * k) for r in range(1, 5) for k in range(1, min(load, 3) + 1)]
    history = spark.createDataFrame(data, "restaurant_id long, valid_from date, cost_for_two long")
    history = history.groupBy("restaurant_id", "valid_from").agg(F.max("cost_for_two").alias("cost_for_two"))
    named = [(r, f"R{r}" if r != 2 or load < 3 else "other name", "Pune", "x") for r in range(1, 5)]
    return history.withColumn("valid_from", F.col("valid_from").cast("timestamp_ntz")), spark.createDataFrame(named, "restaurant_id long, restaurant_name string, city string, cuisine string")


def plain(df):
    return rows(df.select(*[F.col(c).cast("string") for c in sorted(df.columns)]))


@pytest.mark.parametrize("seed", [1, 2])
def test_marts_and_sums_follow_any_series_of_loads(spark, tmp_path, seed):
    rng, path = random.Random(seed), str(tmp_path)
    facts, everything = f"{path}/fct", []
    for load in range(5):
        new = [raw_order(rng, load) for _ in range(14)] if load != 3 else everything[-14:]
        everything += new
        updates = marts.fct_orders(daily.staging.stg_orders(spark.createDataFrame(new, ORDERS)))
        days = upsert.upsert(spark, facts, updates, "order_id", "order_date", changes=f"{path}/changes{load}")
        changes = None if days is None else spark.read.parquet(f"{path}/changes{load}")
        now = tables.read(spark, facts)
        assert plain(now) == plain(marts.fct_orders(daily.staging.stg_orders(spark.createDataFrame(everything, ORDERS))))
        sums = upkeep.refresh_sums(spark, f"{path}/state", now, changes)
        history, names = versions(spark, load)
        assert plain(marts.restaurant_performance(sums["restaurant_sums"], names)) == plain(marts.mart_restaurant_performance(now, names))
        assert plain(marts.delivery_sla(sums["delivery_minutes"])) == plain(marts.mart_delivery_sla(now))
        upkeep.refresh_price_changes(spark, f"{path}/prices", sums["restaurant_days"], changes, history, names)
        stored = tables.read(spark, f"{path}/prices").drop("_changed_month")
        assert plain(stored) == plain(marts.mart_restaurant_price_changes(now, history, names)) and (load == 0 or stored.count() > 3)


def test_old_performance_is_that_of_plain_sql(spark):
    rng = random.Random(7)
    facts = marts.fct_orders(daily.staging.stg_orders(spark.createDataFrame([raw_order(rng, 0) for _ in range(60)], ORDERS)))
    facts.createOrReplaceTempView("facts_of_test")
    want = spark.sql(
        "SELECT restaurant_id, count(*) AS orders, sum(CASE WHEN is_delivered THEN sales_amount ELSE 0 END) AS revenue,"
        " round(avg(customer_rating), 2) AS avg_customer_rating, round(avg(delivery_time_min), 1) AS avg_delivery_min FROM facts_of_test GROUP BY 1"
    )
    got = marts.mart_restaurant_performance(facts, versions(spark, 0)[1])
    assert plain(got.select(*want.columns)) == plain(want)


def test_only_price_changes_that_are_met_are_computed(spark, tmp_path, monkeypatch):
    history = spark.createDataFrame(
        [(r, ts(f"2026-0{m}-01"), 100 * m) for r in (1, 2) for m in (1, 3, 5)], "restaurant_id long, valid_from timestamp_ntz, cost_for_two long"
    )
    names = spark.createDataFrame([(1, "a", "c"), (2, "b", "c")], "restaurant_id long, restaurant_name string, city string")
    order = "restaurant_id long, order_timestamp timestamp_ntz, is_delivered boolean, sales_amount long, _sign int"
    first = spark.createDataFrame([(1, ts("2026-02-27T10:00:00"), True, 5, 1), (2, ts("2026-08-01T10:00:00"), True, 5, 1)], order)
    late = spark.createDataFrame([(1, ts("2026-03-02T10:00:00"), True, 7, 1)], order)
    path, seen = str(tmp_path / "mart"), []
    upkeep.refresh_price_changes(spark, path, marts.restaurant_days(first).withColumn("part", upkeep.month_of("day")), None, history, names)
    compute = marts.price_change_rows
    monkeypatch.setattr(marts, "price_change_rows", lambda changes, *a: seen.extend(rows(changes, "restaurant_id", "changed_on")) or compute(changes, *a))
    both = marts.restaurant_days(first.union(late)).withColumn("part", upkeep.month_of("day"))
    upkeep.refresh_price_changes(spark, path, both, late, history, names)
    assert seen == [(1, day("2026-03-01"))]
    got = rows(tables.read(spark, path), "restaurant_id", "changed_on", "orders_7d_before", "orders_7d_after", "revenue_7d_after")
    assert got == [(1, day("2026-03-01"), 1, 1, 7), (1, day("2026-05-01"), 0, 0, 0), (2, day("2026-03-01"), 0, 0, 0), (2, day("2026-05-01"), 0, 0, 0)]


@pytest.mark.parametrize("seed", [3, 4])
def test_the_ledger_says_what_ranking_all_of_raw_says(spark, tmp_path, seed):
    rng, path = random.Random(seed), str(tmp_path)
    folder, facts, item_facts, waiting = f"{path}/ledger", f"{path}/fct", f"{path}/items", f"{path}/waiting"
    orders, items = [], []
    for load in range(4):
        orders += [raw_order(rng, load) for _ in range(12)]
        items += [raw_item(rng, load) for _ in range(12)]
        raw_orders, raw_items = spark.createDataFrame(orders, ORDERS), spark.createDataFrame(items, ITEMS)
        fresh = raw_orders.where(F.col("_load") == f"l{load}")
        upsert.upsert(spark, facts, marts.fct_orders(daily.staging.stg_orders(fresh)), "order_id", "order_date")
        daily.merge_items(spark, item_facts, waiting, raw_items.where(F.col("_load") == f"l{load}"), facts)
        for _ in range(2 if load == 2 else 1):
            ledger.advance(spark, folder, raw_orders, raw_items)
        whole = checks.reconcile_order_items(raw_items, raw_orders, tables.read(spark, item_facts))
        assert checks.reconcile_orders(raw_orders, tables.read(spark, facts)).isEmpty() and whole.isEmpty()
        for side, at in ((ledger.ORDERS, facts), (ledger.ITEMS, item_facts)):
            assert rows(ledger.reconcile(spark, folder, side, at)) == []
    # One altered fact, in a day that no load touches any more.
    now = tables.read(spark, facts)
    victim = now.orderBy("order_date", "order_id").head()
    of_day = now.where(F.col("order_date") == F.lit(victim.order_date))
    altered = of_day.withColumn("cuisine", F.when(F.col("order_id") == victim.order_id, "other").otherwise(F.col("cuisine")))
    tables.full_refresh(altered, f"{path}/altered")
    tables.overwrite_partitions(spark.read.parquet(f"{path}/altered"), facts, ["order_date"])
    [found] = ledger.reconcile(spark, folder, ledger.ORDERS, facts).collect()
    assert found.raw_orders == found.fct_orders and found.raw_checksum != found.fct_checksum
    assert rows(ledger.reconcile(spark, folder, ledger.ITEMS, item_facts)) == []


def test_a_lost_update_of_the_sums_is_made_up_for(spark, tmp_path, monkeypatch):
    rng, folder = random.Random(5), str(tmp_path)
    orders = [raw_order(rng, 0) for _ in range(10)]
    ledger.absorb(spark, folder, ledger.ORDERS, spark.createDataFrame(orders, ORDERS))
    more = spark.createDataFrame([raw_order(rng, 1) for _ in range(10)], ORDERS)

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken, pytest.raises(RuntimeError, match="driver lost"):
        broken.setattr(deltas, "refresh", lost)
        ledger.absorb(spark, folder, ledger.ORDERS, more)
    ledger.absorb(spark, folder, ledger.ORDERS, more)
    every = ledger.ORDERS.compact(spark.createDataFrame(orders, ORDERS).union(more))
    assert rows(ledger.expected(spark, folder, ledger.ORDERS)) == rows(every.agg(*[F.sum(m) for m in ledger.ORDERS.measures]))


def test_only_changed_days_are_summed_again(spark, tmp_path, monkeypatch):
    rng, path = random.Random(6), str(tmp_path)
    facts = marts.fct_orders(daily.staging.stg_orders(spark.createDataFrame([raw_order(rng, 0) for _ in range(40)], ORDERS)))
    upsert.upsert(spark, f"{path}/fct", facts, "order_id", "order_date")
    ledger.fact_sums(spark, f"{path}/fct", f"{path}/sums", ledger.ORDERS)
    one = facts.where("order_id = 2").withColumns({"cuisine": F.lit("y"), "_loaded_at": F.lit("2027-01-01").cast("timestamp")})
    changed = upsert.upsert(spark, f"{path}/fct", one, "order_id", "order_date")
    read = []
    values = upsert.distinct_values
    monkeypatch.setattr(upsert, "distinct_values", lambda *a: read.append(values(*a)) or read[-1])
    ledger.fact_sums(spark, f"{path}/fct", f"{path}/sums", ledger.ORDERS)
    assert {v for found in read for v in found} == {str(d) for d in changed} and len(changed) == 1


def test_items_are_placed_by_the_index_of_the_orders(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    rng = random.Random(1)
    orders = [(i, ts(f"2026-09-{1 + i % 20:02d}T10:00:00"), day(f"2026-09-{1 + i % 20:02d}"), *raw_order(rng, 0)[3:]) for i in range(60)]
    upsert.upsert(spark, f"{path}/fct", marts.fct_orders(daily.staging.stg_orders(spark.createDataFrame(orders, ORDERS))), "order_id", "order_date")
    meta = source("order_items", "2026-09-01"), ts("2026-09-10"), day("2026-09-10"), "l"
    items = spark.createDataFrame([(1, 5, 1, "f", 10, 1, 10, *meta), (2, 25, 1, "f", 10, 1, 10, *meta), (3, 999, 1, "f", 10, 1, 10, *meta)], ITEMS)
    seen, place = [], upsert.rows_of_keys
    monkeypatch.setattr(upsert, "rows_of_keys", lambda *a: seen.append(place(*a)) or seen[-1])
    daily.merge_items(spark, f"{path}/items", f"{path}/waiting", items, f"{path}/fct")
    assert rows(tables.read(spark, f"{path}/items"), "order_item_id", "order_date") == [(1, day("2026-09-06")), (2, day("2026-09-06"))]
    assert rows(tables.read(spark, f"{path}/waiting"), "order_item_id") == [(3,)]
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in plan or "PartitionFilters: [cast(order_date" in plan or "PartitionFilters: [(order_date" in plan, plan
    assert rows(seen[0].select("order_date").distinct()) == [(day("2026-09-06"),)]


def test_raw_columns_are_those_of_the_platform():
    assert [c.split()[0] for c in ORDERS.split(", ")][:19] == TABLES["orders"].names
    assert [c.split()[0] for c in ITEMS.split(", ")][:7] == TABLES["order_items"].names
