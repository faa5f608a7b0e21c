"""Reconciliation of facts with RAW that reads what a day has changed.

Beside RAW a compact table holds the latest version of each key (what is summed, and a hash of the row), dealt into parts of
neighbouring keys, and sums of it per part. A new load is merged into the parts of its keys; the versions it replaces are
subtracted from the sums, its own are added. Beside the facts there are sums per partition with a mark of the partition's files; a
partition whose files are others is summed again, whoever wrote them. Both sides then add up a few rows: number, amounts and a
checksum of all rows, which any altered, missing or surplus row changes.

Nothing on the RAW side comes from the facts. ``checks.reconcile_orders`` and ``checks.reconcile_order_items`` rank all of RAW and say the same.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.operators import deltas, upsert
from orderlake.operators.quality import drift
from orderlake.plans import marts, staging
from orderlake.session import shared_dir
from orderlake.sources import tables

ORDER_VALUES = [c for c in marts.ORDER_COLUMNS if not c.startswith("_")]
ITEM_VALUES = "order_item_id order_id restaurant_id f_id price quantity line_amount".split()
PART = "part"


@dataclass(frozen=True)
class Side:
    """What is compared of a table: its key, which columns its checksum covers, and what is summed."""

    name: str
    key: str
    latest: Callable[[DataFrame], DataFrame]
    values: tuple[str, ...]
    ties: tuple[str, ...]
    summed: dict[str, Callable[[], Column]]

    @property
    def measures(self) -> list[str]:
        return [*self.summed, "checksum"]

    def columns(self) -> dict[str, Column]:
        """What is summed, of RAW and facts alike."""
        return {n: c() for n, c in self.summed.items()} | {"checksum": F.xxhash64(*self.values).cast("decimal(38,0)")}

    def compact(self, raw: DataFrame) -> DataFrame:
        """Latest RAW rows with the key, what decides versions, what is summed, and the part of the key."""
        kept = dict.fromkeys([self.key, *self.ties, *(["order_id"] if self.key != "order_id" else []), "_source_file", "_loaded_at"])
        rows = self.latest(raw).select(*kept, *[c.alias(n) for n, c in self.columns().items()])
        return rows.withColumn(PART, upsert.part_of(F.col(self.key), "bigint"))

    def signed_sums(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(PART).agg(*[deltas.sum_of(F.col(m)).alias(m) for m in self.measures])

    def of_facts(self) -> list[Column]:
        return [F.sum(F.coalesce(c, F.lit(0))).alias(n) for n, c in self.columns().items()]


ORDERS = Side(
    "orders",
    "order_id",
    staging.stg_orders,
    tuple(ORDER_VALUES),
    ("order_status", "sales_amount"),
    {
        "orders": lambda: F.lit(1).cast("bigint"),
        "delivered_gmv": lambda: F.when(F.col("is_delivered"), F.col("sales_amount")).otherwise(0).cast("decimal(38,0)"),
        "refunded": lambda: (F.col("order_status") == "Refunded").cast("bigint"),
    },
)
ITEMS = Side(
    "items",
    "order_item_id",
    staging.stg_order_items,
    tuple(ITEM_VALUES),
    ("restaurant_id", "f_id", "quantity", "line_amount"),
    {"items": lambda: F.lit(1).cast("bigint"), "amount": lambda: F.col("line_amount").cast("decimal(38,2)")},
)


def absorb(spark: SparkSession, folder: str, side: Side, raw: DataFrame) -> DataFrame:
    """Bring the RAW side up to new RAW rows; returns the latest rows of their keys. Rows may come again."""
    latest, sums, changes = f"{folder}/{side.name}_latest", f"{folder}/{side.name}_sums", f"{folder}/{side.name}_changes"
    # There while the sums lag behind the latest rows; a run that finds it adds the sums up anew.
    unfinished = f"{sums}__unfinished"
    rebuild = tables.is_marked(spark, unfinished)
    tables.mark(spark, unfinished)
    tables.remove(spark, changes)
    rows = side.compact(raw)
    scope = upsert.upsert(spark, latest, rows, side.key, PART, side.ties, fixed_partition=True, changes=changes)
    if scope is None or rebuild:
        now = tables.read(spark, latest) if tables.exists(spark, latest) else rows.limit(0)
        signed = deltas.signed(now)
    else:
        signed = spark.read.parquet(changes) if scope else deltas.signed(rows.limit(0))
        now = signed.where(F.col(deltas.SIGN) > 0).drop(deltas.SIGN)
    deltas.refresh(spark, sums, side.signed_sums(signed), (), side.measures[0], PART, scope is None or rebuild)
    tables.remove(spark, unfinished)
    return now


def absorb_items(spark: SparkSession, folder: str, raw_items: DataFrame) -> None:
    """The same for items, and which of their latest rows belong to no order of RAW: those aren't expected in the facts.

    Only new items and those without an order so far are looked up, in the parts of their orders' keys.
    """
    now = absorb(spark, folder, ITEMS, raw_items)
    path = f"{folder}/items_without_order"
    if tables.exists(spark, path):
        before = tables.read(spark, path)
        now = now.unionByName(before.join(now.select(ITEMS.key), ITEMS.key, "left_anti"))
    staged = shared_dir(spark, "ledger_items")
    try:
        tables.full_refresh(now, f"{staged}/in")
        now = spark.read.schema(now.schema).parquet(f"{staged}/in")
        orders = f"{folder}/orders_latest"
        if tables.exists(spark, orders):
            parts = set(upsert.distinct_values(now.select(upsert.part_of(F.col("order_id"), "bigint").alias(PART)), PART))
            known = tables.read(spark, orders).where(upsert.in_partitions(PART, parts)).select("order_id")
            now = now.join(known, "order_id", "left_anti").select(*now.columns)
        tables.full_refresh(now, f"{staged}/out")
        tables.full_refresh(spark.read.schema(now.schema).parquet(f"{staged}/out"), path)
    finally:
        tables.remove(spark, staged)


def expected(spark: SparkSession, folder: str, side: Side) -> DataFrame:
    """One row: the sums that the facts should have."""
    own = tables.read(spark, f"{folder}/{side.name}_sums").select(*side.measures)
    if side is ITEMS:
        lacking = tables.read(spark, f"{folder}/items_without_order")
        own = own.unionByName(lacking.select(*[(-F.col(m)).alias(m) for m in side.measures]))
    return own.agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in side.measures])


def _file_marks(spark: SparkSession, path: str, partition_by: str) -> DataFrame:
    """A number for the files of each partition, from their names, lengths and times; no file is opened."""
    files = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter="*.parquet").load(path)
    value = F.regexp_extract("path", rf"/{partition_by}=([^/]*)/", 1).alias("value")
    mark = F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")).alias("mark")
    return files.select("path", "length", "modificationTime").groupBy(value).agg(mark)


def fact_sums(spark: SparkSession, path: str, stored: str, side: Side, partition_by: str = "order_date") -> DataFrame:
    """Sums per partition (of dates or numbers) of a fact table; only partitions with other files than at the last call are read."""
    marks = _file_marks(spark, path, partition_by)
    known = tables.read(spark, stored) if tables.exists(spark, stored) else None
    staged = shared_dir(spark, "fact_sums")
    try:
        tables.full_refresh(marks, f"{staged}/marks")
        marks = spark.read.schema(marks.schema).parquet(f"{staged}/marks")
        stale = marks if known is None else marks.join(known, ["value", "mark"], "left_anti")
        values = set(upsert.distinct_values(stale, "value"))
        facts = tables.read(spark, path)
        of_row = F.coalesce(F.col(partition_by).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
        summed = facts.where(of_row.isin(list(values))).groupBy(of_row.alias("value")).agg(*side.of_facts())
        fresh = summed.join(marks, "value")
        if known is not None:
            fresh = fresh.unionByName(known.join(marks, ["value", "mark"], "left_semi").select(*fresh.columns))
        tables.full_refresh(fresh, f"{staged}/sums")
        tables.full_refresh(spark.read.schema(fresh.schema).parquet(f"{staged}/sums"), stored)
    finally:
        tables.remove(spark, staged)
    return tables.read(spark, stored)


def reconcile(spark: SparkSession, folder: str, side: Side, facts: str, partition_by: str = "order_date") -> DataFrame:
    """One row with both sides where they differ, else none."""
    zero = expected(spark, folder, side).limit(0)
    stored = f"{folder}/fct_{side.name}_sums"
    actual = fact_sums(spark, facts, stored, side, partition_by) if tables.exists(spark, facts) else zero
    actual = actual.agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in side.measures])
    return drift(expected(spark, folder, side), actual, ("raw", "fct"), side.measures)


def new_loads(spark: SparkSession, raw: DataFrame, done: str) -> tuple[DataFrame, DataFrame]:
    """The rows of RAW whose load isn't among those done, and those loads. Loads come in the order of their days."""
    found = raw.select("_load_day", "_load")
    if tables.exists(spark, done):
        known = tables.read(spark, done)
        last = known.agg(F.max("_load_day")).head()[0]
        found = found.where(F.col("_load_day") >= F.lit(last)) if last else found
        found = found.distinct().join(known, ["_load_day", "_load"], "left_anti")
    found = found.distinct()
    listed = found.limit(upsert.MOST_PARTITIONS + 1).collect()
    if len(listed) > upsert.MOST_PARTITIONS:
        raise ValueError(f"more than {upsert.MOST_PARTITIONS} new loads")
    days, names = {r["_load_day"] for r in listed}, {r["_load"] for r in listed}
    rows = raw.where(F.col("_load_day").isin(list(days)) & F.col("_load").isin(list(names)))
    schema = "_load_day date, _load string"
    return rows, spark.createDataFrame([(r["_load_day"], r["_load"]) for r in listed], schema)


def advance(spark: SparkSession, folder: str, raw_orders: DataFrame, raw_items: DataFrame) -> None:
    """Bring the RAW side up to all loads of RAW."""
    for name, raw, take in (
        ("orders", raw_orders, lambda rows: absorb(spark, folder, ORDERS, rows)),
        ("items", raw_items, lambda rows: absorb_items(spark, folder, rows)),
    ):
        done = f"{folder}/{name}_loads"
        rows, loads = new_loads(spark, raw, done)
        take(rows)
        loads.write.mode("append").parquet(done)
