import random

import pytest
from helpers import day, rows, source, ts
from pyspark.sql import functions as F

from orderlake.operators import versions
from orderlake.plans import marts, reports, staging
from orderlake.sources import sample_tables as sample

RAW = "id int, value string, _source_file string, _loaded_at timestamp"


def test_latest_version(spark):
    df = spark.createDataFrame(
        [
            (1, "initial", None, None),
            (1, "new day", source("t", "2026-09-03"), ts("2026-09-04")),
            (1, "old day again", source("t", "2026-09-01"), ts("2026-09-09")),
            (2, "first load", source("t", "2026-09-01"), ts("2026-09-02")),
            (2, "second load", source("t", "2026-09-01"), ts("2026-09-03")),
            (3, "no metadata", None, None),
            (3, "static reload", "raw/t/t.csv", ts("2026-08-01")),
        ],
        RAW,
    )
    assert rows(versions.dedup_latest(df, "id"), "id", "value") == [
        (1, "new day"),
        (2, "second load"),
        (3, "static reload"),
    ]


def test_hot_key_is_cut_before_the_shuffle(spark):
    raw = sample.raw_order_items(lambda name: sample.table(spark, "/root/testdata/sf0.001", name))
    plan = versions.dedup_latest(raw, "order_id")._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "row_number(), 1, Partial" in plan[exchange:] and "row_number(), 1, Final" in plan[:exchange]


def test_ranges_skip_repeats_and_see_nulls(spark):
    df = spark.createDataFrame(
        [
            (1, day("2026-01-01"), "A", None),
            (1, day("2026-01-02"), "A", None),
            (1, day("2026-01-03"), None, "A"),
            (1, day("2026-01-04"), "A", None),
            (2, day("2026-01-01"), None, None),
            (2, day("2026-01-02"), None, None),
        ],
        "k int, start date, a string, b string",
    )
    got = versions.scd2_ranges(df, "k", "start", ["a", "b"])
    assert rows(got, "k", "start", "a", "b", "valid_to", "is_current") == [
        (1, day("2026-01-01"), "A", None, day("2026-01-03"), False),
        (1, day("2026-01-03"), None, "A", day("2026-01-04"), False),
        (1, day("2026-01-04"), "A", None, None, True),
        (2, day("2026-01-01"), None, None, None, True),
    ]


def test_two_loads_of_one_day_give_one_version(spark):
    columns = "_idx id name city rating rating_count cost cuisine lic_no link address menu".split()
    base = dict(_idx="0", id="7", name="R", city="A,Pune", rating="4.1", rating_count="20+ ratings", cost="₹ 200",
                cuisine="Pizzas", lic_no="L", link="", address="", menu="")
    day1 = source("restaurants", "2026-09-01")
    data = [
        base | {"_source_file": None, "_loaded_at": None},
        base | {"cost": "₹ 300", "_source_file": day1, "_loaded_at": ts("2026-09-02")},
        base | {"cost": "₹ 250", "_source_file": day1, "_loaded_at": ts("2026-09-05")},
        base | {"id": "07", "cost": "₹ 260", "_source_file": day1, "_loaded_at": ts("2026-09-04")},
        base | {"id": "id", "_source_file": None, "_loaded_at": None},
    ]
    schema = ", ".join(f"{c} string" for c in columns) + ", _source_file string, _loaded_at timestamp"
    raw = spark.createDataFrame([tuple(r[c] for c in [*columns, "_source_file", "_loaded_at"]) for r in data], schema)
    history = marts.dim_restaurants_history(staging.stg_restaurant_versions(raw))
    assert rows(history, "restaurant_version_key", "cost_for_two", "is_current") == [
        ("7-19000101", 200, False),
        ("7-20260901", 250, True),
    ]


def brute_as_of(left, right):
    out = []
    for key, at in left:
        hits = [v for k, start, end, v in right if k == key and key is not None and at >= start and (end is None or at < end)]
        assert len(hits) <= 1
        out.append((key, at, hits[0] if hits else None))
    return sorted(out, key=str)


def test_as_of_join_equals_brute_force(spark):
    rnd = random.Random(5)
    right = []
    for key in range(6):
        starts = sorted({ts("2024-01-01") + rnd.randrange(900) * (ts("2024-01-02") - ts("2024-01-01")) for _ in range(5)})
        if key % 2:
            starts.insert(0, ts("1900-01-01"))
        ends = starts[1:] + [None]
        right += [(key, a, b, f"{key}/{i}") for i, (a, b) in enumerate(zip(starts, ends))]
    second = (ts("2024-01-01T00:00:01") - ts("2024-01-01"))
    # Key 1 holds a third of the rows; some rows sit exactly on a boundary; key 99 and NULL match nothing.
    left = [(rnd.choice([1, 1, 0, 2, 3, 4, 5, 99, None]), ts("2023-11-01") + rnd.randrange(86400 * 1100) * second) for _ in range(600)]
    left += [(k, a) for k, a, _, _ in right if a.year > 1900] + [(k, b - second) for k, _, b, _ in right if b]
    lf = spark.createDataFrame(left, "k int, at timestamp_ntz")
    rf = spark.createDataFrame(right, "k int, valid_from timestamp_ntz, valid_to timestamp_ntz, v string")
    got = versions.as_of_join(lf, rf, "k", "at", lf, "at")
    assert sorted((tuple(r) for r in got.select("k", "at", "v").collect()), key=str) == brute_as_of(left, right)


def test_a_stray_timestamp_adds_one_month_only(spark):
    left = [(1, ts("2024-01-05")), (1, ts("2024-03-05")), (1, ts("9999-12-01")), (1, None)]
    lf = spark.createDataFrame(left, "k int, at timestamp_ntz")
    rf = spark.createDataFrame([(1, ts("1900-01-01"), ts("2024-02-01"), "x"), (1, ts("2024-02-01"), None, "y")], "k int, valid_from timestamp_ntz, valid_to timestamp_ntz, v string")
    joined = versions.as_of_join(lf, rf, "k", "at", lf, "at")
    assert rows(joined, "at", "v") == [(None, None), (ts("2024-01-05"), "x"), (ts("2024-03-05"), "y"), (ts("9999-12-01"), "y")]
    plan = joined._jdf.queryExecution().executedPlan()
    joined.collect()
    assert "_version_month" in plan.toString() and "sequence(" not in plan.toString()


def test_as_of_join_of_nothing(spark):
    lf = spark.createDataFrame([], "k int, at timestamp_ntz")
    rf = spark.createDataFrame([(1, ts("1900-01-01"), None, "x")], "k int, valid_from timestamp_ntz, valid_to timestamp_ntz, v string")
    assert versions.as_of_join(lf, rf, "k", "at", lf, "at").count() == 0


def history_frame(spark, data):
    return spark.createDataFrame(
        data, "restaurant_id bigint, valid_from timestamp_ntz, cost_for_two bigint, rating decimal(3,1)"
    )


def test_price_changes_and_their_windows(spark):
    from decimal import Decimal

    history = history_frame(
        spark,
        [
            (1, ts("1900-01-01"), 200, Decimal("4.0")),
            (1, ts("2026-09-10"), 200, Decimal("4.5")),
            (1, ts("2026-09-15"), 300, Decimal("4.5")),
            (2, ts("1900-01-01"), None, None),
            (2, ts("2026-09-15"), 300, None),
            (2, ts("2026-09-18"), None, None),
            (3, ts("1900-01-01"), 100, None),
            (3, ts("2026-09-12"), 50, None),
        ],
    )
    orders = spark.createDataFrame(
        [
            (1, ts("2026-09-08T00:00:00"), True, 10),
            (1, ts("2026-09-07T23:59:59"), True, 1000),
            (1, ts("2026-09-14T23:59:59"), False, 20),
            (1, ts("2026-09-15T00:00:00"), True, 40),
            (1, ts("2026-09-21T23:59:59"), True, 80),
            (1, ts("2026-09-22T00:00:00"), True, 1000),
            (2, ts("2026-09-16T12:00:00"), True, None),
            (9, ts("2026-09-20T01:00:00"), True, 5),
        ],
        "restaurant_id bigint, order_timestamp timestamp_ntz, is_delivered boolean, sales_amount bigint",
    )
    restaurants = spark.createDataFrame([(1, "One", "Pune")], "restaurant_id bigint, restaurant_name string, city string")
    got = marts.mart_restaurant_price_changes(orders, history, restaurants)
    assert rows(
        got, "restaurant_id", "city", "changed_on", "old_cost_for_two", "new_cost_for_two", "price_change_pct",
        "orders_7d_before", "orders_7d_after", "revenue_7d_before", "revenue_7d_after", "days_observed_after",
    ) == [
        (1, "Pune", day("2026-09-15"), 200, 300, 0.5, 2, 2, 10, 120, 7),
        (2, None, day("2026-09-18"), 300, None, None, 1, 0, None, 0, 5),
        (3, None, day("2026-09-12"), 100, 50, -0.5, 0, 0, 0, 0, 7),
    ]
    nothing = marts.mart_restaurant_price_changes(orders.where("false"), history, restaurants)
    assert {r["days_observed_after"] for r in nothing.collect()} == {None}


def test_status_changes_of_an_order_sent_many_times(spark):
    data = [(1, "Delivered", source("orders", f"2026-09-{d:02d}"), ts(f"2026-09-{d:02d}")) for d in range(1, 20)] * 20
    data += [(1, "Refunded", source("orders", "2026-09-20"), ts("2026-09-21")), (2, "Cancelled", source("orders", "2026-09-01"), ts("2026-09-02"))]
    raw = spark.createDataFrame(data, "order_id bigint, order_status string, _source_file string, _loaded_at timestamp")
    assert rows(reports.status_changes(raw)) == [(1, day("2026-09-20"), "Delivered", "Refunded")]


def test_delivery_percentiles_equal_numpy(spark):
    import numpy as np

    rnd = random.Random(3)
    minutes = {("Pune", 10): [rnd.randrange(8, 90) for _ in range(200)], ("Delhi", 9): [5], ("Delhi", 10): [1, 2]}
    data = [(c, ts(f"2026-09-01T{h:02d}:30:00"), True, m) for (c, h), ms in minutes.items() for m in ms]
    data += [("Pune", ts("2026-09-01T10:00:00"), True, None), ("Pune", ts("2026-09-01T10:00:00"), False, 500)]
    orders = spark.createDataFrame(data, "city string, order_timestamp timestamp_ntz, is_delivered boolean, delivery_time_min bigint")
    got = {(r.city, r.order_hour): (r.delivered_orders, r.p50, r.p90) for r in marts.mart_delivery_sla(orders).collect()}
    for key, values in minutes.items():
        n, p50, p90 = got[key]
        assert n == len(values) + (key == ("Pune", 10))
        assert p50 == pytest.approx(np.percentile(values, 50), abs=0.051)
        assert p90 == pytest.approx(np.percentile(values, 90), abs=0.051)


def test_calendar(spark):
    dates = marts.dim_date(spark)
    assert dates.count() == 1096
    assert rows(dates.where("date_day = '2024-01-06'")) == [(day("2024-01-06"), 2024, 1, "Jan", "Sat", True)]


def test_review_with_late_empty_resend_keeps_its_comment(spark):
    raw = spark.createDataFrame(
        [
            (1, 10, 5, 7, 4, "good", day("2026-09-02"), source("reviews", "2026-09-02"), ts("2026-09-03")),
            (1, 10, 5, 7, 1, None, day("2026-09-02"), source("reviews", "2026-09-05"), ts("2026-09-06")),
        ],
        "review_id bigint, order_id bigint, user_id bigint, restaurant_id bigint, rating bigint, comment string, "
        "review_date date, _source_file string, _loaded_at timestamp",
    )
    restaurants = spark.createDataFrame([], "restaurant_id bigint, city string")
    assert rows(staging.stg_reviews(raw, restaurants), "rating", "comment", "city") == [(4, "good", None)]


def test_repeated_versions_are_not_broadcast(spark):
    """A few versions over many months are many rows, which Spark takes for few."""
    history = spark.range(50).select("id", F.lit("1990-01-01").cast("timestamp").alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"))
    days = F.expr("timestampadd(MONTH, cast(id as int), timestamp'1995-01-15')").alias("ts")
    left = spark.range(50).select("id", days)
    found = versions.as_of_join(left, history.withColumn("known", F.lit(True)), "id", "ts", left, "ts")
    assert found.where("known").count() == 50
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
