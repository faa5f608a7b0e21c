from helpers import day, rows, source, ts
from pyspark.sql import functions as F

from orderlake.operators import quality
from orderlake.plans import checks, reports


def test_checks_return_failing_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c"), (None, "d")], "k int, v string")
    assert rows(quality.duplicates(df, "k")) == [(1, 2)]
    assert rows(quality.missing(df, "v")) == [(2, None)]
    assert rows(quality.unexpected_values(df, "v", ["a", "b"])) == [("c", 1), ("d", 1)]
    parent = spark.createDataFrame([(2,), (2,)], "id int")
    assert rows(quality.orphans(df, "k", parent, "id")) == [(1, 2)]


def test_key_checks_and_severity(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "c"), (None, None)], "k int, v string")
    report = checks.with_status(checks.key_checks("t", df, "k", True, ["k", "v"], warn=["v"]))
    assert rows(report) == [
        ("not_null t.k", "error", 2, "error"),
        ("not_null t.v", "warn", 2, "warn"),
        ("unique t.k", "error", 1, "error"),
    ]
    empty = checks.with_status(checks.key_checks("t", df.where("false"), "k", True, ["v"]))
    assert [r[2:] for r in rows(empty)] == [(0, "pass"), (0, "pass")]


def test_reconcile_finds_drift(spark):
    raw = spark.createDataFrame(
        [
            (1, "Delivered", 10, source("orders", "2026-09-01"), ts("2026-09-02")),
            (1, "Refunded", 10, source("orders", "2026-09-02"), ts("2026-09-03")),
            (2, "Delivered", 5, source("orders", "2026-09-01"), ts("2026-09-02")),
        ],
        "order_id bigint, order_status string, sales_amount bigint, _source_file string, _loaded_at timestamp",
    )
    schema = "order_id bigint, order_status string, is_delivered boolean, sales_amount bigint"
    stale = spark.createDataFrame([(1, "Delivered", True, 10), (2, "Delivered", True, 5)], schema)
    good = spark.createDataFrame([(1, "Refunded", False, 10), (2, "Delivered", True, 5)], schema)
    assert checks.reconcile_orders(raw, good).count() == 0
    assert rows(checks.reconcile_orders(raw, stale)) == [(2, 2, 5, 15, 1, 0)]


def test_history_current(spark):
    history = spark.createDataFrame([(1, False), (1, True), (2, True), (2, True), (3, False)], "restaurant_id bigint, is_current boolean")
    known = spark.createDataFrame([(1,), (2,)], "restaurant_id bigint")
    assert rows(checks.history_current(history, known)) == [(None, 1), (2, 2), (3, 0)]


def test_amounts(spark):
    orders = spark.createDataFrame(
        [(1, 50, 0, 20, 2, 72), (2, 50, 0, 20, 3, 73), (3, 100, 10, 0, 5, 96), (4, 100, 0, 0, 5, 105), (5, None, 0, 0, None, None)],
        "order_id bigint, subtotal bigint, discount bigint, delivery_fee bigint, gst bigint, sales_amount bigint",
    )
    items = spark.createDataFrame(
        [(1, 25, 2, 50), (2, 50, 1, 50), (3, 100, 1, 100), (4, 50, 1, 50), (4, 40, 1, 41)],
        "order_id bigint, price bigint, quantity bigint, line_amount bigint",
    )
    got = reports.amount_consistency(orders, items)
    assert rows(got, "order_id", "bad_subtotal", "bad_lines", "bad_gst", "bad_sales_amount") == [
        (2, False, False, True, False),
        (3, False, False, False, True),
        (4, True, True, False, False),
    ]


def test_late_and_feed_summary(spark):
    schema = "order_id bigint, order_date date, order_status string, _source_file string, _loaded_at timestamp"

    def order(i, d, file, status="Delivered"):
        return (i, day(d), status, source("orders", file), ts("2026-10-01"))

    raw = spark.createDataFrame(
        [
            order(1, "2026-09-01", "2026-09-01"),
            order(2, "2026-09-01", "2026-09-02"),
            order(3, "2026-09-02", "2026-09-02"),
            order(1, "2026-09-01", "2026-09-02", "Refunded"),
            order(4, "2026-08-01", None),
        ],
        schema,
    )
    assert rows(reports.late_arrivals(raw)) == [
        (day("2026-08-01"), 1, 0, 0.0),
        (day("2026-09-01"), 2, 1, 0.5),
        (day("2026-09-02"), 1, 0, 0.0),
    ]
    nothing = raw.where("false")
    assert rows(reports.daily_feed_summary(raw, raw, nothing, nothing)) == [
        (None, 1, 0, 0, 1, 0, 0),
        (day("2026-09-01"), 1, 0, 0, 1, 0, 0),
        (day("2026-09-02"), 1, 1, 1, 3, 0, 0),
    ]


def test_eligibility(spark):
    orders = spark.createDataFrame(
        [(1, day("2026-09-01"), "Delivered"), (1, day("2026-09-01"), "Refunded"), (2, day("2026-09-01"), "Cancelled")],
        "order_id bigint, order_date date, order_status string",
    )
    found = spark.createDataFrame(
        [(10, 1, day("2026-09-02")), (11, 1, day("2026-09-03")), (12, 2, day("2026-09-02")), (13, 9, day("2026-09-02"))],
        "review_id bigint, order_id bigint, review_date date",
    )
    assert rows(reports.review_eligibility(found, orders), "review_id", "reason") == [
        (11, "not the next day"),
        (12, "not delivered"),
        (13, "unknown order"),
    ]


def test_anomaly_days(spark):
    data = [("Pune", day(f"2026-09-{d:02d}"), 30) for d in range(1, 10) for _ in range(3)]
    data += [("Pune", day("2026-09-10"), 42)] * 3 + [("Pune", day("2026-09-11"), 41)] * 3 + [("Pune", day("2026-09-12"), 90)]
    data += [("Goa", day("2026-09-10"), 99)] * 3
    orders = spark.createDataFrame(data, "city string, order_date date, delivery_time_min bigint")
    no_reviews = spark.createDataFrame([], "city string, review_date date, rating bigint")
    baseline_free = reports.anomaly_days(orders.where("order_date < '2026-09-11'"), no_reviews)
    assert rows(baseline_free) == [("delivery_time", "Pune", day("2026-09-10"), 3, 42.0, 30.0, None)]
    assert rows(reports.anomaly_days(orders, no_reviews), "day", "deviations") == [(day("2026-09-12"), 13.04)]


def test_anomaly_over_a_zero_baseline(spark):
    calm = [("Pune", day(f"2026-09-{d:02d}"), 5) for d in range(1, 10) for _ in range(4)]
    bad = [("Pune", day("2026-09-10"), 1)] * 20 + [("Goa", day("2026-09-10"), 5), ("Goa", day("2026-09-11"), 5)]
    reviews = spark.createDataFrame(calm + bad, "city string, review_date date, rating bigint")
    no_orders = spark.createDataFrame([], "city string, order_date date, delivery_time_min bigint")
    assert rows(reports.anomaly_days(no_orders, reviews)) == [("negative_reviews", "Pune", day("2026-09-10"), 20, 1.0, 0.0, None)]
    one_more = reviews.unionByName(reviews.where("review_date = '2026-09-05'").limit(1).selectExpr("city", "review_date", "2L AS rating"))
    assert (day("2026-09-10"), 20) in rows(reports.anomaly_days(no_orders, one_more), "day", "n")


def test_totals_that_are_null_on_one_side_differ(spark):
    some = spark.createDataFrame([(2, 5)], "n bigint, amount bigint")
    none = spark.createDataFrame([(2, None)], "n bigint, amount bigint")
    assert rows(quality.drift(some, none, ("a", "b"), ["n", "amount"])) == [(2, 2, 5, None)]
    assert rows(quality.drift(none, none, ("a", "b"), ["n", "amount"])) == []


def test_trace_fields(spark, tmp_path):
    df = spark.createDataFrame([(1, '{"tool": "search", "ms": 12}'), (2, "not json"), (3, '{"ms": "x"}')], "id int, trace string")
    reports.append_traces(df, str(tmp_path / "log"), "trace")
    assert rows(reports.trace_fields(spark.read.parquet(str(tmp_path / "log")), "trace", ["id"])) == [
        (1, "ms", "12", 12),
        (1, "tool", "search", None),
        (2, None, None, None),
        (3, "ms", "x", None),
    ]


def test_parents_are_not_broadcast(spark):
    values, parent = spark.range(100).select((F.col("id") % 7).alias("k")), spark.range(5).select(F.col("id").alias("p"))
    found = quality.orphans(values, "k", parent, "p")
    assert rows(found) == [(5, 14), (6, 14)]
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()


def test_checks_run_one_after_another(spark):
    """The report holds totals: no join of any check is left in its plan."""
    from orderlake import registry

    report = registry.QUERIES["dq_report"](spark, "/root/testdata/sf0.001")
    assert report.count() == 24
    assert not any(step in report._jdf.queryExecution().executedPlan().toString() for step in ("Join", "Window", "FileScan"))
