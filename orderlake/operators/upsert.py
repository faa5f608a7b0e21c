"""Incremental writes: lookback filter, partition-scoped upsert, append of absent keys."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import settings
from orderlake.operators import slices
from orderlake.operators.versions import first_per_group, version_order
from orderlake.session import shared_dir, shuffles_dropped
from orderlake.sources import tables


def lookback_cutoff(target: DataFrame, days: int = settings.LOOKBACK_DAYS) -> DataFrame:
    """One row, one column: newest load time of the target minus the lookback."""
    newest = F.coalesce(F.max("_loaded_at"), F.lit("1900-01-01").cast("timestamp"))
    return target.agg((newest - F.expr(f"interval {days} days")).alias("cutoff"))


def loaded_since(df: DataFrame, target: DataFrame, days: int = settings.LOOKBACK_DAYS) -> DataFrame:
    """Rows loaded after the target's newest load time minus the lookback.

    The filter is on load time, never on event time: late rows have an old event time.
    """
    return df.where(F.col("_loaded_at") > lookback_cutoff(target, days).scalar())


def recent_raw(raw: DataFrame, target: DataFrame | None, days: int = settings.LOOKBACK_DAYS) -> DataFrame:
    """``loaded_since`` for RAW rows, as plain comparisons that reach the Parquet scan.

    The cutoff is read first (one row). Rows without a load time count as the initial load. Where
    the table has a ``_load_day`` partition, older days are not listed at all.
    """
    if target is None:
        return raw
    bounds = lookback_cutoff(target, days).select(
        "cutoff",
        F.to_date("cutoff").alias("day"),
        (F.lit(settings.INITIAL_LOAD_AT).cast("timestamp") > F.col("cutoff")).alias("undated"),
    )
    cutoff, day, undated = bounds.head()
    recent = F.col("_loaded_at") > F.lit(cutoff)
    since = F.col("_load_day") >= F.lit(day) if "_load_day" in raw.columns else F.lit(True)
    if undated:
        recent, since = recent | F.col("_loaded_at").isNull(), since | F.col("_loaded_at").isNull()
    return raw.where(recent & since)


def append_new_columns(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Union in which either side may lack columns; those are NULL there."""
    return existing.unionByName(incoming, allowMissingColumns=True)


# A change set may touch this many partitions; more means that the table is partitioned by something
# finer than a calendar, which a driver should not list.
MOST_PARTITIONS = 100_000


def distinct_values(df: DataFrame, column: str) -> list:
    """Distinct partition values of a change set; their number is checked, since the driver holds them."""
    values = [row[0] for row in df.select(column).distinct().limit(MOST_PARTITIONS + 1).collect()]
    if len(values) > MOST_PARTITIONS:
        raise ValueError(f"the change set touches over {MOST_PARTITIONS} partitions of {column}")
    return values


def rows_per_value(df: DataFrame, column: str) -> dict:
    """Partition values of a change set with their numbers of rows; checked as ``distinct_values``."""
    counts = {value: n for value, n in df.groupBy(column).agg(F.count(F.lit(1))).limit(MOST_PARTITIONS + 1).collect()}
    if len(counts) > MOST_PARTITIONS:
        raise ValueError(f"the change set touches over {MOST_PARTITIONS} partitions of {column}")
    return counts


def merge_latest(existing: DataFrame, updates: DataFrame, key: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Existing rows and updates reduced to the latest version of each key.

    The order of versions is that of ``dedup_latest``; of two equal versions the update stays, so
    a re-read row brings its new columns.
    """
    both = append_new_columns(existing.withColumn("_update", F.lit(0)), updates.withColumn("_update", F.lit(1)))
    order = version_order() + [F.col("_update").desc()] + [F.col(c).asc_nulls_last() for c in tiebreak]
    return first_per_group(both, [key], order).drop("_update")


# Keys per part of the index where keys are whole numbers, which mostly grow with time, and the
# number of parts where they are not.
KEYS_PER_PART, PARTS = 1_000_000, 4096


def part_of(key: Column, kind: str) -> Column:
    """The part of the index a key is in: neighbouring numbers are together, other keys are dealt out."""
    if kind in ("bigint", "int", "smallint", "tinyint"):
        return F.floor(key / KEYS_PER_PART).cast("bigint")
    return F.pmod(F.xxhash64(key), F.lit(PARTS))


def _places(df: DataFrame, key: str, partition_by: str) -> DataFrame:
    """Index rows of table rows: key, the partition it is in, and the part of the index."""
    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("k"), F.col(partition_by).alias("p"), part_of(F.col(key), kind).alias("part"))


def index_path(path: str) -> str:
    return f"{path.rstrip('/')}__keys"


def _read_index(spark: SparkSession, path: str, kinds) -> DataFrame:
    schema = f"k {kinds[0]}, p {kinds[1]}, part bigint"
    return spark.read.schema(schema).parquet(index_path(path))


def _with_keys(rows: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    """Rows whose key is (``left_semi``) or isn't (``left_anti``) among the keys; NULL is a key like any other."""
    return rows.join(keys, rows[key].eqNullSafe(keys["k"]), how)


def upsert(
    spark: SparkSession,
    path: str,
    updates: DataFrame | Iterable[DataFrame],
    key: str,
    partition_by: str,
    tiebreak: Sequence[str] = (),
    fixed_partition: bool = False,
    changes: str | None = None,
) -> set | None:
    """Merge updates into a Parquet table on a key, rewriting only the partitions they touch.

    Versions are compared for the updates' keys only; the other rows of a touched partition are copied, and where the keys are
    few enough to be broadcast they aren't shuffled. The touched partitions are read and dynamically overwritten; the old
    files stay until the job commits, so a lost executor only repeats its tasks. Where a key was before is looked up in an
    index beside the table, of which only the parts of the updates' keys are read, and rewritten where a place is new.
    ``fixed_partition=True`` promises that a key never changes its partition; there is no index
    then. Repeating an upsert changes nothing. Returns the partitions that were rewritten or dropped,
    or None where the table was new.

    Updates may come in parts, which are staged one after the other. Many rows are merged in slices of neighbouring partitions, so that
    only a slice's shuffles are on disk at a time; keys that are in partitions of several slices are merged together before.
    The new partitions of all slices take the place of the old ones at the end.

    ``changes`` names a folder that gets, before the table changes, the updates' keys as signed rows: what the table had of them with
    ``_sign`` -1, what it will have with 1. A new table leaves it empty: all of its rows are new.
    """
    order = version_order() + [F.col(c).asc_nulls_last() for c in tiebreak]
    staged = shared_dir(spark, "updates")
    try:
        # Written once: the partition list, the index lookup and the merge all read the same rows.
        updates = tables.staged(spark, [updates] if isinstance(updates, DataFrame) else updates, f"{staged}/in")
        with shuffles_dropped(spark):
            new = not tables.exists(spark, path)
            rows = rows_per_value(updates, partition_by)
            touched, homes = set(rows), set()
            if not touched and not new:
                return set()
            kinds = [updates.schema[c].dataType.simpleString() for c in (key, partition_by)]
            known = here = None
            if not new:
                target = tables.read(spark, path)
                target = target.withColumn(partition_by, F.col(partition_by).cast(kinds[1]))
                if not fixed_partition:
                    if not tables.exists(spark, index_path(path)):
                        tables.overwrite_partitions(_places(target, key, partition_by), index_path(path), ["part"], ["k"])
                    keys = updates.select(F.col(key).alias("k"))
                    known = _known_places(spark, path, keys, kinds)
                    found = _with_keys(known, keys, "k", "left_semi")
                    homes = set(distinct_values(found, "p"))
                here = target.where(in_partitions(partition_by, touched | homes))
                for value, n in rows_per_value(here, partition_by).items():
                    rows[value] = rows.get(value, 0) + n
            scope = touched | homes
            ranges = slices.ranges({value: rows.get(value, 0) for value in scope})
            if new and len(ranges) < 2:
                latest = first_per_group(updates, [key], order)
                tables.overwrite_partitions(latest, path, [partition_by], [key])
                _index_all(spark, path, key, partition_by, fixed_partition)
                return None

            number = slices.by_range(F.col(partition_by), ranges)
            rounds, crossing = [(here, updates)], None
            if len(ranges) > 1:
                dealt = slices.Sliced(spark, f"{staged}/dealt")
                dealt.add(updates, number)
                tables.remove(spark, f"{staged}/in")
                places = dealt.all().select(F.col(key).alias("k"), F.col("_slice").alias("s"))
                if known is not None:
                    found = _with_keys(known, places, "k", "left_semi")
                    places = places.unionByName(found.select("k", slices.by_range(F.col("p"), ranges).alias("s")))
                several = places.groupBy("k").agg(F.min("s").alias("s"), F.max("s").alias("t")).where("s < t").select("k")
                crossing = tables.staged(spark, [several], f"{staged}/crossing")
                if crossing.isEmpty():
                    crossing = None
                rounds = [
                    (None if new else here.where(in_partitions(partition_by, values)), _without(dealt.slice(i), crossing, key))
                    for i, values in enumerate(ranges)
                ]
                if crossing is not None:
                    rounds.append((here, _with_keys(dealt.all().drop("_slice"), crossing, key, "left_semi")))

            merged = slices.Sliced(spark, f"{staged}/latest")
            for i, (had, came) in enumerate(rounds):
                if new:
                    merged.add(first_per_group(came, [key], order), number)
                else:
                    old = _with_keys(had, came.select(F.col(key).alias("k")), key, "left_semi")
                    merged.add(merge_latest(old, came, key, tiebreak), number)
                    if changes is not None:
                        # Keys of several slices come last: until then a slice has the rows of its own round.
                        now = merged.slice(i) if i < len(ranges) else _with_keys(merged.all().drop("_slice"), crossing, key, "left_semi")
                        signed = append_new_columns(old.withColumn("_sign", F.lit(-1)), now.withColumn("_sign", F.lit(1)))
                        signed.write.mode("append" if i else "overwrite").parquet(changes)
            for folder in ("in", "dealt"):
                tables.remove(spark, f"{staged}/{folder}")
            latest = merged.all().drop("_slice")
            if new:
                whole = (merged.slice(i) for i in range(len(ranges)))
                tables.overwrite_partitions_in_turn(whole, path, [partition_by], [key])
                _index_all(spark, path, key, partition_by, fixed_partition)
                return None

            keys = latest.select(F.col(key).alias("k"))
            # An overwrite leaves a partition alone that gets no row. That needs a moved key, and such
            # partitions are dropped afterwards.
            left = homes - set(distinct_values(latest, partition_by)) if homes else set()
            kept = _with_keys(here.where(in_partitions(partition_by, left)), keys, key, "left_anti")
            emptied = left - set(distinct_values(kept, partition_by)) if left else set()

            def after(i: int) -> DataFrame:
                now = merged.slice(i) if len(ranges) > 1 else latest
                kept = here.where(in_partitions(partition_by, ranges[i])) if len(ranges) > 1 else here
                kept = _with_keys(kept, now.select(F.col(key).alias("k")), key, "left_anti")
                return append_new_columns(_without(kept, crossing, key), now)

            if len(ranges) > 1:
                tables.overwrite_partitions_in_turn((after(i) for i in range(len(ranges))), path, [partition_by], [key])
            else:
                tables.overwrite_partitions(after(0), path, [partition_by], [key])
            tables.drop_partitions(spark, path, partition_by, emptied)
            if not fixed_partition:
                placed = _places(latest, key, partition_by)
                same = placed.k.eqNullSafe(known.k) & placed.p.eqNullSafe(known.p)
                if not placed.join(known, same, "left_anti").isEmpty():
                    moved = _with_keys(known, keys, "k", "left_anti").unionByName(placed)
                    tables.overwrite_partitions(moved, index_path(path), ["part"], ["k"])
            return scope
    finally:
        tables.remove(spark, staged)


def _without(rows: DataFrame, keys: DataFrame | None, key: str) -> DataFrame:
    return rows if keys is None else _with_keys(rows, keys, key, "left_anti")


def _index_all(spark: SparkSession, path: str, key: str, partition_by: str, fixed_partition: bool) -> None:
    if not fixed_partition and tables.exists(spark, path):
        tables.overwrite_partitions(_places(tables.read(spark, path), key, partition_by), index_path(path), ["part"], ["k"])


def _known_places(spark: SparkSession, path: str, keys: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """The index in the parts where the keys (``k``) are."""
    parts = distinct_values(keys.select(part_of(F.col("k"), kinds[0]).alias("part")), "part")
    return _read_index(spark, path, kinds).where(in_partitions("part", set(parts)))


def rows_of_keys(spark: SparkSession, path: str, keys: DataFrame, key: str, partition_by: str) -> DataFrame:
    """A table in the partitions where the keys (the only column of ``keys``) are, by its index; without an index all of it."""
    target = tables.read(spark, path)
    if not tables.exists(spark, index_path(path)):
        return target
    kinds = [target.schema[c].dataType.simpleString() for c in (key, partition_by)]
    keys = keys.toDF("k").select(F.col("k").cast(kinds[0])).distinct()
    homes = distinct_values(_with_keys(_known_places(spark, path, keys, kinds), keys, "k", "left_semi"), "p")
    return target.where(in_partitions(partition_by, set(homes)))


def in_partitions(column: str, values: set) -> Column:
    known = [v for v in values if v is not None]
    test = F.col(column).isin(known)
    return test | F.col(column).isNull() if None in values else test


def rows_absent(incoming: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Incoming rows whose key is not there yet."""
    return incoming.join(existing.select(key), key, "left_anti")


def insert_if_absent(
    spark: SparkSession, path: str, incoming: DataFrame, key: str, order: Sequence[Column] = ()
) -> None:
    """Append rows with new keys; a key that comes twice is written once."""
    new = rows_absent(incoming, tables.read(spark, path), key) if tables.exists(spark, path) else incoming
    first_per_group(new, [key], list(order) or [F.col(key)]).write.mode("append").parquet(path)
