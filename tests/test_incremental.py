import random

import pytest
from helpers import day, rows, source, ts
from pyspark.sql import functions as F

from orderlake.operators import upsert
from orderlake.operators.versions import dedup_latest
from orderlake.plans import daily
from orderlake.sources import tables

SCHEMA = "id bigint, order_date date, status string, _source_file string, _loaded_at timestamp"


def orders(spark, *data):
    return spark.createDataFrame(
        [(i, day(d), status, source("orders", file), ts(loaded)) for i, d, status, file, loaded in data], SCHEMA
    )


def merge(spark, path, df, **options):
    upsert.upsert(spark, path, df, "id", "order_date", **options)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "fct")


def test_late_and_resent_rows(spark, path):
    merge(spark, path, orders(spark, (1, "2026-09-01", "Delivered", "2026-09-01", "2026-09-02"), (2, "2026-09-02", "Delivered", "2026-09-02", "2026-09-03")))
    second = orders(
        spark,
        (1, "2026-09-01", "Refunded", "2026-09-02", "2026-09-03"),
        (3, "2026-09-01", "Delivered", "2026-09-02", "2026-09-03"),
    )
    for _ in range(2):
        merge(spark, path, second)
        assert rows(tables.read(spark, path), "id", "status") == [(1, "Refunded"), (2, "Delivered"), (3, "Delivered")]


def test_older_day_loaded_again_does_not_win(spark, path):
    merge(spark, path, orders(spark, (1, "2026-09-01", "Refunded", "2026-09-02", "2026-09-03")))
    merge(spark, path, orders(spark, (1, "2026-09-01", "Delivered", "2026-09-01", "2026-09-20")))
    assert rows(tables.read(spark, path), "id", "status") == [(1, "Refunded")]


def test_untouched_partitions_keep_their_files(spark, path):
    import glob

    merge(spark, path, orders(spark, (1, "2026-09-01", "a", "2026-09-01", "2026-09-02"), (2, "2026-09-02", "b", "2026-09-02", "2026-09-03")))
    before = set(glob.glob(f"{path}/order_date=2026-09-01/*.parquet"))
    merge(spark, path, orders(spark, (2, "2026-09-02", "c", "2026-09-03", "2026-09-04")))
    assert before and before == set(glob.glob(f"{path}/order_date=2026-09-01/*.parquet"))


@pytest.mark.parametrize("others", [(), ((5, "2026-09-01", "stays", "2026-09-01", "2026-09-02"),)])
def test_key_that_moves_to_another_partition(spark, path, others):
    merge(spark, path, orders(spark, (1, "2026-09-01", "a", "2026-09-01", "2026-09-02"), *others))
    merge(spark, path, orders(spark, (1, "2026-09-03", "b", "2026-09-03", "2026-09-04")))
    expected = [(1, day("2026-09-03"), "b")] + [(o[0], day(o[1]), o[2]) for o in others]
    assert rows(tables.read(spark, path), "id", "order_date", "status") == expected


def test_new_column_is_null_for_old_rows(spark, path):
    merge(spark, path, orders(spark, (1, "2026-09-01", "a", "2026-09-01", "2026-09-02"), (2, "2026-09-02", "b", "2026-09-02", "2026-09-03")))
    new = orders(spark, (2, "2026-09-02", "b", "2026-09-02", "2026-09-03"), (3, "2026-09-02", "c", "2026-09-02", "2026-09-03"))
    merge(spark, path, new.withColumn("tip", F.lit(7)))
    assert rows(tables.read(spark, path), "id", "tip") == [(1, None), (2, 7), (3, 7)]


def test_only_the_index_parts_of_the_updates_keys_are_read(spark, path, monkeypatch):
    old = [(i * 10, f"2026-0{1 + i % 8}-01", "a", "2026-09-01", "2026-09-02") for i in range(40)]
    merge(spark, path, orders(spark, *old, (5_000_000, "2026-09-01", "a", "2026-09-01", "2026-09-02")))
    seen = []
    read = upsert._read_index

    def watched(*args):
        seen.append(read(*args))
        return seen[-1]

    monkeypatch.setattr(upsert, "_read_index", watched)
    merge(spark, path, orders(spark, (5_000_001, "2026-09-02", "b", "2026-09-02", "2026-09-03")))
    merge(spark, path, orders(spark, (5_000_000, "2026-09-03", "c", "2026-09-04", "2026-09-05")))
    assert rows(tables.read(spark, path).where("id > 1000"), "id", "order_date", "status") == [
        (5_000_000, day("2026-09-03"), "c"), (5_000_001, day("2026-09-02"), "b")]
    plan = seen[0].where(F.col("part").isin([5]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and "order_date" not in plan
    index = spark.read.parquet(upsert.index_path(path))
    assert rows(index.where("part = 5"), "k", "p") == [(5_000_000, day("2026-09-03")), (5_000_001, day("2026-09-02"))]
    assert index.count() == tables.read(spark, path).count()


def test_text_keys_move_too(spark, path):
    def frame(*data):
        return orders(spark, *data).withColumn("id", F.concat(F.lit("k"), "id"))

    merge(spark, path, frame((1, "2026-09-01", "a", "2026-09-01", "2026-09-02"), (2, "2026-09-01", "b", "2026-09-01", "2026-09-02")))
    merge(spark, path, frame((1, "2026-09-04", "c", "2026-09-04", "2026-09-05")))
    assert rows(tables.read(spark, path), "id", "order_date") == [("k1", day("2026-09-04")), ("k2", day("2026-09-01"))]


def test_nothing_staged_stays_after_a_failure(spark, path, monkeypatch):
    folders = []
    monkeypatch.setattr(upsert, "shared_dir", lambda spark, name: folders.append(f"{path}-{name}") or folders[-1])
    merge(spark, path, orders(spark, (1, "2026-09-01", "a", "2026-09-01", "2026-09-02")))
    monkeypatch.setattr(tables, "overwrite_partitions", lambda *args: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        merge(spark, path, orders(spark, (1, "2026-09-01", "b", "2026-09-02", "2026-09-03")))
    assert folders and not any(tables.exists(spark, f) for f in folders)


def test_too_many_partitions_are_refused(spark, path, monkeypatch):
    monkeypatch.setattr(upsert, "MOST_PARTITIONS", 2)
    first = orders(spark, (1, "2026-09-01", "a", "2026-09-01", "2026-09-02"))
    merge(spark, path, first)
    with pytest.raises(ValueError, match="partitions"):
        merge(spark, path, orders(spark, *[(i, f"2026-09-0{i}", "a", "2026-09-01", "2026-09-02") for i in (1, 2, 3)]))


def test_no_updates(spark, path):
    merge(spark, path, orders(spark, (1, "2026-09-01", "a", "2026-09-01", "2026-09-02")))
    merge(spark, path, orders(spark))
    assert tables.read(spark, path).count() == 1


def test_lookback_is_on_load_time(spark):
    target = orders(spark, (1, "2026-09-01", "a", "2026-09-01", "2026-09-10"))
    incoming = orders(
        spark,
        (2, "2020-01-01", "late", "2026-09-09", "2026-09-08"),
        (3, "2026-09-10", "on the edge", "2026-09-06", "2026-09-07"),
    )
    assert rows(upsert.loaded_since(incoming, target), "id") == [(2,)]
    assert rows(upsert.loaded_since(incoming, target.where("false")), "id") == [(2,), (3,)]
    undated = incoming.unionByName(incoming.where("id = 2").withColumns({"id": F.lit(4), "_loaded_at": F.lit(None).cast("timestamp")}))
    assert rows(upsert.recent_raw(undated, target), "id") == [(2,)]
    early = orders(spark, (1, "2026-06-01", "a", "2026-06-01", "2026-06-02"))
    assert rows(upsert.recent_raw(undated, early), "id") == [(2,), (3,), (4,)]
    assert rows(upsert.recent_raw(undated, None), "id") == [(2,), (3,), (4,)]


def test_insert_if_absent(spark, path):
    first = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id bigint, v string")
    upsert.insert_if_absent(spark, path, first, "id", [F.col("v").desc()])
    upsert.insert_if_absent(spark, path, spark.createDataFrame([(2, "x"), (3, "y")], "id bigint, v string"), "id")
    assert rows(spark.read.parquet(path)) == [(1, "b"), (2, "c"), (3, "y")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_order_of_loads_equals_a_rebuild(spark, path, seed):
    rnd = random.Random(seed)
    data = []
    for load in range(40):
        i = rnd.choice([1, 1, 1, 2, 3, 4, 5])
        order_day = f"2026-09-0{rnd.choice([i, i, i, 7])}"
        data.append((i, order_day, f"s{load}", f"2026-09-{rnd.randrange(10, 20)}", f"2026-09-20T00:00:{load:02d}"))
    everything = orders(spark, *data)
    rnd.shuffle(data)
    for start in range(0, 40, 14):
        merge(spark, path, orders(spark, *data[start : start + 14]))
    columns = ["id", "order_date", "status"]
    assert rows(tables.read(spark, path), *columns) == rows(dedup_latest(everything, "id"), *columns)


def snapshot(spark, path, data, when):
    current = spark.createDataFrame(data, "id bigint, name string, rating int, other string")
    daily.apply_snapshot(spark, path, current, "id", ["name", "rating"], F.lit(when).cast("timestamp"))
    return rows(tables.read(spark, path), "id", "name", "rating", F.col("dbt_valid_from").cast("string"), F.col("dbt_valid_to").cast("string"))


def test_snapshot(spark, path):
    d1, d2, d3 = "2026-09-01 00:00:00", "2026-09-02 00:00:00", "2026-09-03 00:00:00"
    first = [(1, "a", 4, "x"), (2, "b", None, "x"), (3, "c", 1, "x")]
    got = snapshot(spark, path, first, d1)
    assert got == [(1, "a", 4, d1, None), (2, "b", None, d1, None), (3, "c", 1, d1, None)]
    # 1 changes a value that is not tracked, 2 changes from NULL, 3 is gone, 4 is new.
    second = [(1, "a", 4, "y"), (2, "b", 5, "x"), (4, "d", 2, "x")]
    expected = [
        (1, "a", 4, d1, None),
        (2, "b", None, d1, d2),
        (2, "b", 5, d2, None),
        (3, "c", 1, d1, None),
        (4, "d", 2, d2, None),
    ]
    assert snapshot(spark, path, second, d2) == expected
    assert snapshot(spark, path, second, d3) == expected
    ids = tables.read(spark, path).select("dbt_scd_id")
    assert ids.distinct().count() == len(expected)
    # A second run on a closing day keeps what the day closed before.
    third = snapshot(spark, path, [(1, "z", 4, "y"), (2, "b", 5, "x"), (4, "d", 2, "x")], d2)
    assert (2, "b", None, d1, d2) in third and (1, "a", 4, d1, d2) in third and (1, "z", 4, d2, None) in third


def test_merge_queries_derive_their_orders_once(spark):
    """Three loads of items read one written copy of the orders' columns, instead of deriving the orders for each."""
    from orderlake import registry

    registry.QUERIES["incremental_merge_items"](spark, "/root/testdata/sf0.001")
    written = registry.lake_of(spark, "/root/testdata/sf0.001")._written
    assert set(written["placed_orders"].columns) == {"order_id", "order_timestamp", "order_date", "city"}


def test_merges_with_sums_derive_raw_orders_once(spark):
    from orderlake import registry

    registry.QUERIES["reconcile_from_ledger"](spark, "/root/testdata/sf0.001")
    assert "raw_orders" in registry.lake_of(spark, "/root/testdata/sf0.001")._written
