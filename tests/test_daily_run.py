"""Three days of files through the whole run, then the same day again."""

import csv

import pytest
from helpers import day, rows
from pyspark.sql import functions as F

from orderlake.operators import upsert
from orderlake.plans import daily
from orderlake.plans.marts import mart_daily_city_revenue
from orderlake.plans.reviews import ReviewQuery, hashed_vectors, question_vector, review_search, search_reviews
from orderlake.sources.schemas import TABLES
from orderlake.streaming import ingest


def put(lake, table, rows_, ds=None):
    folder = lake / table / f"dt={ds}" if ds else lake / table
    folder.mkdir(parents=True, exist_ok=True)
    with open(folder / f"{table}_{ds or 'all'}.csv", "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(TABLES[table].names)
        writer.writerows(rows_)


def order(i, ds, restaurant=1, status="Delivered", subtotal=100):
    gst = round(subtotal * 0.05)
    minutes, rating = ("30.0", "5.0") if status == "Delivered" else ("", "")
    return [i, f"{ds} 12:00:00", ds, 1, restaurant, "Kothrud,Pune", "Pizzas", 1, 1, subtotal, 0, 20, gst, subtotal + 20 + gst,
            "INR", "UPI", status, rating, minutes]


def item(i, order_id, amount=100, restaurant=1):
    return [i, order_id, restaurant, "fd1", amount, 1, amount]


def restaurant(i, cost, rating="4.0"):
    return [0, i, f"R{i}", "Kothrud,Pune", rating, "20+ ratings", f"₹ {cost}", "Pizzas", "L", "", "", ""]


@pytest.fixture(scope="module")
def lake(tmp_path_factory):
    lake = tmp_path_factory.mktemp("lake")
    put(lake, "users", [[0, 1, "Jane", "Jane.Doe@Example.com", "pw", "30", "F", "Single", "x", "y", "z", "2"]])
    put(lake, "food", [[0, "fd1", "Dosa", "VEG"]])
    put(lake, "menu", [[0, "mn1", "1", "fd1", "Pizzas", "100.0"]])
    put(lake, "restaurants", [restaurant(1, 200), restaurant(2, 500)], "2026-09-01")
    put(lake, "orders", [order(1, "2026-09-01"), order(2, "2026-09-01", restaurant=2)], "2026-09-01")
    put(lake, "order_items", [item(11, 1), item(12, 2)], "2026-09-01")
    put(lake, "reviews", [], "2026-09-01")
    # Day 2: order 3 of day 1 comes late, order 2 is refunded, restaurant 1 raises its price.
    put(lake, "restaurants", [restaurant(1, 250)], "2026-09-02")
    put(lake, "orders", [order(4, "2026-09-02"), order(3, "2026-09-01"), order(2, "2026-09-01", 2, "Refunded")], "2026-09-02")
    put(lake, "order_items", [item(14, 4), item(13, 3)], "2026-09-02")
    put(lake, "reviews", [[21, 1, 1, 1, 1, "Delayed for ages and then missing.", "2026-09-02"]], "2026-09-02")
    # Day 3
    put(lake, "restaurants", [restaurant(1, 250, "4.2")], "2026-09-03")
    put(lake, "orders", [order(5, "2026-09-03", status="Cancelled")], "2026-09-03")
    put(lake, "order_items", [item(15, 5)], "2026-09-03")
    put(lake, "reviews", [[22, 4, 1, 1, 5, "Quick, and a real bargain.", "2026-09-03"],
                          [23, 3, 1, 1, 1, "Delayed for ages and then missing.", "2026-09-03"]], "2026-09-03")
    return lake


def run(spark, lake, path, ds):
    return daily.run_day(spark, str(lake), path, ds, run_at=F.lit(f"{ds} 23:00:00").cast("timestamp"))


@pytest.fixture(scope="module")
def warehouse(spark, lake, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warehouse"))
    reports = [rows(run(spark, lake, path, ds), "check_name", "status") for ds in ("2026-09-01", "2026-09-02", "2026-09-03")]
    return daily.Warehouse(spark, path), reports


def test_quality_passes_every_day(warehouse):
    for report in warehouse[1]:
        assert {status for _, status in report} == {"pass"}, report


def test_facts_hold_latest_versions(warehouse):
    w, _ = warehouse
    assert rows(w.fct_orders, "order_id", "order_status") == [
        (1, "Delivered"), (2, "Refunded"), (3, "Delivered"), (4, "Delivered"), (5, "Cancelled")]
    assert rows(w.fct_order_items, "order_item_id", "order_date") == [
        (11, day("2026-09-01")), (12, day("2026-09-01")), (13, day("2026-09-01")), (14, day("2026-09-02")), (15, day("2026-09-03"))]


def test_point_in_time_price(warehouse):
    w, _ = warehouse
    assert rows(w.fct_orders_point_in_time.where("restaurant_id = 1"), "order_id", "cost_for_two_at_order", "cost_for_two_current") == [
        (1, 200, 250), (3, 200, 250), (4, 250, 250), (5, 250, 250)]


def test_marts(warehouse):
    w, _ = warehouse
    assert rows(w.mart("mart_daily_city_revenue"), "order_date", "orders", "delivered_orders", "gmv") == [
        (day("2026-09-01"), 3, 2, 250), (day("2026-09-02"), 1, 1, 125), (day("2026-09-03"), 1, 0, 0)]
    assert rows(w.mart("mart_restaurant_price_changes"), "restaurant_id", "orders_7d_before", "orders_7d_after", "days_observed_after") == [
        (1, 2, 2, 2)]
    assert rows(w.mart("dim_customer"), "email", "age_segment") == [("jane.doe@example.com", "Millennial")]


def test_only_changed_days_of_a_mart_are_rebuilt(spark, tmp_path):
    w = daily.Warehouse(spark, str(tmp_path))

    def facts(*data):
        return spark.createDataFrame([(day(d), n) for d, n in data], "order_date date, n bigint")

    def totals(df):
        return df.groupBy("order_date").agg(F.sum("n").alias("n"))

    daily.refresh_days(w, "m", totals, facts(("2026-09-01", 1), ("2026-09-02", 2), ("2026-09-03", 3)), "order_date", None)
    changed = facts(("2026-09-01", 100), ("2026-09-02", 5))
    daily.refresh_days(w, "m", totals, changed, "order_date", {day("2026-09-02"), day("2026-09-03")})
    assert rows(w.mart("m"), "order_date", "n") == [(day("2026-09-01"), 1), (day("2026-09-02"), 5)]
    daily.refresh_days(w, "m", totals, changed, "order_date", set())
    assert w.mart("m").count() == 2


def test_a_run_lost_behind_the_merge_leaves_no_old_revenue(spark, tmp_path, monkeypatch):
    lake, path = tmp_path / "lake", str(tmp_path / "warehouse")
    first, second = "2026-08-01", "2026-09-02"
    # Order 2 leaves the first day on the second.
    put(lake, "orders", [order(1, first), order(2, first)], first)
    put(lake, "orders", [order(2, second)], second)
    w = daily.Warehouse(spark, path)

    def build(ds):
        ingest.ingest_day(spark, str(lake), "orders", ds, path)
        daily.build_core(w, F.lit(f"{ds} 23:00:00").cast("timestamp"))

    def lost(*_):
        raise RuntimeError("driver lost")

    for name in ("refresh_order_items", "refresh_reviews", "apply_snapshot"):
        monkeypatch.setattr(daily, name, lambda *_, **__: None)
    whole = daily.tables.full_refresh

    def out_of_lookback(raw, target, *_):
        # Load times are the clock's; here what came on the first day is older than the lookback.
        return raw if target is None else raw.where(F.contains("_source_file", F.lit(f"dt={second}")))

    monkeypatch.setattr(daily.incremental, "recent_raw", out_of_lookback)

    def needed_only(df, at, *by):
        if by or "/marts/" not in at or "dim_restaurants" in at:
            whole(df, at, *by)

    monkeypatch.setattr(daily.tables, "full_refresh", needed_only)
    build(first)
    with monkeypatch.context() as broken, pytest.raises(RuntimeError, match="driver lost"):
        broken.setattr(daily, "refresh_days", lost)
        build(second)
    build(second)
    assert rows(w.mart("mart_daily_city_revenue"), "order_date", "orders") == [(day(first), 1), (day(second), 1)]
    assert not (tmp_path / "warehouse/marts/mart_daily_city_revenue__unfinished").exists()


def test_snapshot_records_when_a_change_was_seen(spark, warehouse):
    w, _ = warehouse
    history = spark.read.parquet(w.location("snapshots", "restaurants")).where("restaurant_id = 1")
    assert rows(history, "cost_for_two", F.col("rating").cast("string"), F.to_date("dbt_valid_from"), F.to_date("dbt_valid_to")) == [
        (200, "4.0", day("2026-09-01"), day("2026-09-02")),
        (250, "4.0", day("2026-09-02"), day("2026-09-03")),
        (250, "4.2", day("2026-09-03"), None)]


def test_labels_vectors_and_search(spark, warehouse):
    w, _ = warehouse
    assert rows(w.labels, "review_id", "sentiment_label", "topic") == [
        (21, "negative", "delivery"), (22, "positive", "delivery"), (23, "negative", "delivery")]
    vectors = w.written("ai", "review_embeddings")
    assert vectors.count() == 2
    question = question_vector(spark, "delayed for ages", hashed_vectors)
    found = review_search(w.mart_review_search, vectors, question, ReviewQuery(query="delayed for ages", sentiment="negative"))
    assert [(r.comment, r.n_reviews, r.review_id, r.order_id) for r in found.collect()] == [
        ("Delayed for ages and then missing.", 2, 23, 3), ("Delayed for ages and then missing.", 2, 21, 1)]


def test_sql_on_views(spark, warehouse):
    w, _ = warehouse
    daily.register_views(w)
    top = spark.sql("SELECT city, sum(gmv) AS gmv FROM mart_daily_city_revenue GROUP BY city ORDER BY gmv DESC LIMIT 1")
    assert rows(top) == [("Pune", 375)]
    assert rows(spark.sql("SELECT email FROM stg_users")) == [("jane.doe@example.com",)]
    names = daily.register_views(w, for_analysts=True)
    assert "stg_users" not in names and "email" not in spark.table("dim_customer").columns
    assert not [c for c in spark.table("fct_orders").columns if c.startswith("_")]


def test_search_from_plain_arguments(warehouse):
    w, _ = warehouse
    mart, vectors = w.mart_review_search, w.written("ai", "review_embeddings")
    found = search_reviews(mart, vectors, hashed_vectors, query="delayed for ages", city="pune", k=1)
    assert (found.matching_reviews, found.filters, found.note, found.error) == (3, {"city": "pune"}, None, None)
    [best] = found.as_dict()["results"]
    assert (best["text"], best["reviews"], [e["review_id"] for e in best["examples"]]) == ("Delayed for ages and then missing.", 2, [23, 21])
    assert search_reviews(mart, vectors, hashed_vectors, city="Nowhere").results == []
    assert "angry" in search_reviews(mart, vectors, hashed_vectors, sentiment="angry").error


def test_a_repeated_day_changes_nothing(spark, lake, warehouse):
    w, _ = warehouse
    names = ["dim_restaurants_history", "mart_daily_city_revenue", "mart_review_search", "mart_review_insights"]
    before = {n: rows(w.mart(n)) for n in names}
    facts, raw = rows(w.fct_orders), w.raw("orders").count()
    report = run(spark, lake, w.path, "2026-09-03")
    assert {r["status"] for r in report.collect()} == {"pass"}
    assert before == {n: rows(w.mart(n)) for n in names}
    assert (facts, raw) == (rows(w.fct_orders), w.raw("orders").count())


def test_stream_loads_new_files_only(spark, tmp_path):
    lake, raw, check = tmp_path / "lake", str(tmp_path / "raw"), str(tmp_path / "check")
    put(lake, "orders", [order(1, "2026-09-01")], "2026-09-01")

    def load():
        ingest.ingest(spark, "orders", str(lake / "orders"), raw, check).awaitTermination()
        return rows(spark.read.parquet(raw), "order_id", "customer_rating")

    assert load() == [(1, 5)]
    assert load() == [(1, 5)]
    put(lake, "orders", [order(2, "2026-09-02", status="Cancelled")], "2026-09-02")
    assert load() == [(1, 5), (2, None)]
    assert spark.read.parquet(raw).select("_loaded_at").distinct().count() == 2


def test_old_files_load_too(spark, tmp_path):
    import os

    lake, raw, check = tmp_path / "lake", str(tmp_path / "raw"), str(tmp_path / "check")
    put(lake, "orders", [order(1, "2026-09-01")], "2026-09-01")
    put(lake, "orders", [order(2, "2026-09-02")], "2026-09-02")
    old = lake / "orders" / "dt=2026-09-02" / "orders_2026-09-02.csv"
    os.utime(old, (os.path.getmtime(old) - 40 * 86400,) * 2)
    ingest.ingest(spark, "orders", str(lake / "orders"), raw, check).awaitTermination()
    put(lake, "orders", [order(3, "2026-09-03")], "2026-09-03")
    late = lake / "orders" / "dt=2026-09-03" / "orders_2026-09-03.csv"
    os.utime(late, (os.path.getmtime(late) - 400 * 86400,) * 2)
    ingest.ingest(spark, "orders", str(lake / "orders"), raw, check).awaitTermination()
    assert rows(spark.read.parquet(raw), "order_id") == [(1,), (2,), (3,)]


def test_rejected_lines_are_kept(spark, tmp_path):
    folder = tmp_path / "lake" / "food"
    folder.mkdir(parents=True)
    (folder / "food.csv").write_text('i,f,item,v\n1,fd1,"Two\nlines",Veg\n2,"fd2,Open,Veg\n3,fd3,c,Veg\n', encoding="utf-8")
    raw = str(tmp_path / "raw" / "food")
    ingest.ingest(spark, "food", str(folder), raw, str(tmp_path / "check")).awaitTermination()
    assert rows(spark.read.parquet(raw), "f_id", "item") == [("fd1", "Two\nlines"), ("fd3", "c")]
    kept = daily.Warehouse(spark, str(tmp_path)).rejects("food")
    assert rows(kept, "line", "reason") == [('2,"fd2,Open,Veg', "a quote is never closed")]


def test_an_item_that_came_long_before_its_order(spark, tmp_path):
    lake, path = tmp_path / "lake", str(tmp_path / "warehouse")
    for table in ("users", "food", "menu"):
        put(lake, table, [])
    for ds, orders_, items in (("2026-09-01", [order(1, "2026-09-01")], [item(11, 1), item(12, 2)]),
                               ("2026-09-08", [order(3, "2026-09-08")], [item(13, 3)]),
                               ("2026-09-15", [order(2, "2026-09-15")], [])):
        put(lake, "orders", orders_, ds)
        put(lake, "order_items", items, ds)
        put(lake, "restaurants", [restaurant(1, 200)], ds)
        put(lake, "reviews", [], ds)
        w = daily.Warehouse(spark, path)
        for table in TABLES:
            ingest.ingest_day(spark, str(lake), table, ds, path)
        daily.build_core(w, F.lit(f"{ds} 23:00:00").cast("timestamp"))
    assert rows(w.fct_order_items, "order_item_id", "order_date") == [
        (11, day("2026-09-01")), (12, day("2026-09-15")), (13, day("2026-09-08"))]
    assert w.written("staging", "items_without_order").count() == 0


def test_a_capped_run_moves_past_reviews_that_fail(spark, lake, warehouse, tmp_path):
    import json

    def labeller(comment):
        raise TimeoutError("no reply") if "Delayed" in comment else AssertionError(comment)

    w, _ = warehouse
    other = daily.Warehouse(spark, w.path)
    other.location = lambda layer, name: str(tmp_path / name) if layer == "ai" else f"{w.path}/{layer}/{name}"
    for n in range(3):
        daily.enrich(other, labeller, "m", F.lit(f"2026-09-0{4 + n}").cast("timestamp"), 1)
    tried = [r.review_id for r in other.written("ai", "quarantine").orderBy("asked_at").collect()]
    assert tried == [21, 22, 23] and json.dumps(tried)


def test_vectors_of_another_length_are_refused(spark, warehouse, tmp_path):
    w, _ = warehouse
    other = daily.Warehouse(spark, w.path)
    other.location = lambda layer, name: str(tmp_path / name) if layer == "ai" else f"{w.path}/{layer}/{name}"
    at = F.lit("2026-09-04").cast("timestamp")
    daily.embed(other, lambda texts: [[1.0, 2.0]] * len(texts), "two", at, 1)
    with pytest.raises(ValueError, match="another length"):
        daily.embed(other, lambda texts: [[1.0, 2.0, 3.0]] * len(texts), "two", at, None)
    daily.embed(other, lambda texts: [[1.0, 2.0, 3.0]] * len(texts), "three", at, None)
    assert rows(other.written("ai", "review_embeddings").groupBy("model").count()) == [("three", 2), ("two", 1)]


def test_continuous_ingest(spark, tmp_path):
    lake, raw, check = tmp_path / "lake", str(tmp_path / "raw"), str(tmp_path / "check")
    put(lake, "orders", [order(1, "2026-09-01")], "2026-09-01")
    load = ingest.ingest(spark, "orders", str(lake / "orders"), raw, check, every="1 second")
    try:
        load.processAllAvailable()
        put(lake, "orders", [order(2, "2026-09-02")], "2026-09-02")
        load.processAllAvailable()
    finally:
        load.stop()
    assert rows(spark.read.parquet(raw), "order_id") == [(1,), (2,)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookback_reaches_the_scan(warehouse):
    w, _ = warehouse
    plan = plan_of(upsert.recent_raw(w.raw("orders"), w.fct_orders))
    assert "PartitionFilters: [isnotnull(_load_day" in plan or "PartitionFilters: [((_load_day" in plan, plan
    assert "GreaterThan(_loaded_at" in plan


def test_marts_read_only_their_columns(warehouse):
    w, _ = warehouse
    plan = plan_of(mart_daily_city_revenue(w.fct_orders))
    [schema] = [line for line in plan.split("ReadSchema: ")[1:]]
    read = {part.split(":")[0] for part in schema.split("struct<")[1].split(">")[0].split(",")}
    assert read == {"city", "order_status", "is_delivered", "sales_amount"}


def test_all_reviews_are_labelled_by_default(warehouse):
    w, _ = warehouse
    assert w.labels.count() == w.stg_reviews.count() == 3


def test_labelling_model_in_the_run(spark, lake, warehouse, tmp_path):
    import json

    def labeller(comment):
        if "bargain" in comment:
            return "no idea"
        return json.dumps({"sentiment_label": "negative", "sentiment_score": -1, "topic": "delivery", "key_issue": "late"})

    w, _ = warehouse
    other = daily.Warehouse(spark, w.path)
    other.location = lambda layer, name: str(tmp_path / name) if layer == "ai" else f"{w.path}/{layer}/{name}"
    at = F.lit("2026-09-04").cast("timestamp")
    for _ in range(2):
        daily.enrich(other, labeller, "m", at, None)
    assert rows(other.labels, "review_id", "model") == [(21, "m"), (23, "m")]
    asked = spark.read.parquet(str(tmp_path / "quarantine"))
    assert rows(asked, "review_id", "problem") == [(22, "not readable")] * 2
