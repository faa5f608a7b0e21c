"""Merges of many rows go in slices, give the same rows, and leave no shuffle files."""

import random
import time

import pytest
from helpers import day, rows, source, ts

from orderlake.operators import slices, upsert
from orderlake.operators.versions import dedup_latest
from orderlake.plans import daily
from orderlake.sources import tables

SCHEMA = "id bigint, order_date date, status string, _source_file string, _loaded_at timestamp"


def orders(spark, *data):
    return spark.createDataFrame(
        [(i, d and day(d), status, source("orders", file), ts(loaded)) for i, d, status, file, loaded in data], SCHEMA
    )


def loads(seed):
    """Keys that come again on their day, move to other days, have none or are NULL."""
    rnd, data = random.Random(seed), []
    for load in range(60):
        i = rnd.choice([1, 1, 1, 2, 3, 4, 5, 6, 7, 8, None])
        order_day = rnd.choice([f"2026-09-0{i or 9}"] * 4 + ["2026-09-07", None])
        data.append((i, order_day, f"s{load}", f"2026-09-{rnd.randrange(10, 20)}", f"2026-09-20T00:00:{load % 60:02d}"))
    rnd.shuffle(data)
    return data


@pytest.mark.parametrize("seed", [1])
def test_a_merge_in_slices_equals_a_rebuild(spark, tmp_path, monkeypatch, seed):
    monkeypatch.setattr(slices, "ROWS_PER_SLICE", 4)
    data, columns = loads(seed), ["id", "order_date", "status"]
    path, parts = str(tmp_path / "fct"), []
    ranges = slices.ranges
    monkeypatch.setattr(slices, "ranges", lambda counts: parts.append(ranges(counts)) or parts[-1])
    for n, start in enumerate(range(0, 60, 20)):
        part = data[start : start + 20]
        before = rows(tables.read(spark, path), *columns) if n else []
        changes = f"{tmp_path}/changes{n}"
        # One table of updates, then some that come in parts.
        frames = orders(spark, *part) if n < 2 else (orders(spark, *part[k : k + 7]) for k in range(0, 20, 7))
        done = upsert.upsert(spark, path, frames, "id", "order_date", changes=changes)
        expected = rows(dedup_latest(orders(spark, *data[: start + 20]), "id"), *columns)
        assert rows(tables.read(spark, path), *columns) == expected
        index = spark.read.parquet(upsert.index_path(path))
        assert rows(index, "k", "p") == rows(tables.read(spark, path), "id", "order_date")
        if n:
            signed = rows(spark.read.parquet(changes), *columns, "_sign")
            came = {r[0] for r in part}
            assert sorted(map(str, signed)) == sorted(
                [str((*r, -1)) for r in before if r[0] in came] + [str((*r, 1)) for r in expected if r[0] in came]
            )
            assert {r[1] for r in signed} <= done
    assert all(len(p) > 2 for p in parts)
    assert not [p for p in tmp_path.iterdir() if "__new" in p.name]


def test_items_in_slices_meet_their_orders_and_others_wait(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    raw = spark.createDataFrame(
        [
            # The newer version of item 7 is of another order, that of item 8 of an order nobody knows.
            (k, o, 1, f"fd{k}", 5, q, 5 * q, source("order_items", f"2026-09-0{v}"), ts(f"2026-09-0{v}"))
            for k, o, q, v in [(k, k % 6, 1, 1) for k in range(12)] + [(7, 4, 2, 2), (8, 99, 2, 2), (9, None, 2, 2)]
        ],
        "order_item_id bigint, order_id bigint, r_id bigint, f_id string, price bigint, quantity bigint, line_amount bigint, "
        "_source_file string, _loaded_at timestamp",
    )
    facts = spark.createDataFrame(
        [(o, ts(f"2026-09-0{o + 1}"), day(f"2026-09-0{o + 1}"), "c", None, ts("2026-09-01")) for o in range(6)],
        "order_id bigint, order_timestamp timestamp, order_date date, city string, _source_file string, _loaded_at timestamp",
    )
    found = {}
    for name, size in (("whole", 1000), ("sliced", 5)):
        monkeypatch.setattr(slices, "ROWS_PER_SLICE", size)
        at = f"{path}/{name}"
        for late in (False, True):
            upsert.upsert(spark, f"{at}/orders", facts.where(f"(order_id = 3) = {late}"), "order_id", "order_date")
            daily.merge_items(spark, f"{at}/fct", f"{at}/waiting", raw.where(str(not late)), f"{at}/orders")
            found[name, late] = [rows(tables.read(spark, f"{at}/{t}"), "order_item_id", "order_id", "quantity") for t in ("fct", "waiting")]
    assert found["whole", False] == found["sliced", False] and found["whole", True] == found["sliced", True]
    items, waiting = found["sliced", True]
    assert sorted(items) == [(k, k % 6 if k != 7 else 4, 1 + (k == 7)) for k in (0, 1, 2, 3, 4, 5, 6, 7, 10, 11)]
    assert waiting == [(8, 99, 2), (9, None, 2)]


def test_no_shuffle_files_stay_after_a_merge(spark, tmp_path):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {f for f in disk.getAllFiles().mkString(" ").split() if "/shuffle_" in f}

    before, path = shuffled(), str(tmp_path / "fct")
    for load in ("2026-09-02", "2026-09-03"):
        data = [(i, f"2026-09-0{1 + i % 4}", "a", load, load) for i in range(40)]
        upsert.upsert(spark, path, orders(spark, *data).repartition(3), "id", "order_date")
    for _ in range(50):
        if not (left := shuffled() - before):
            break
        time.sleep(0.1)
    assert not left
