"""Versioned rows: latest version, validity ranges, as-of join, snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.functions.scalars import file_date


def first_per_group(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each group.

    Spark keeps at most ``n`` rows per group in every input task before it shuffles, so a key
    that holds a large share of the rows sends only ``n`` rows per task to its reducer.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def version_order(source_file: str = "_source_file", loaded_at: str = "_loaded_at") -> list[Column]:
    """Newest first: day of the file, then load time; the initial load comes last."""
    return [file_date(source_file).desc_nulls_last(), F.col(loaded_at).desc_nulls_last()]


def dedup_latest(df: DataFrame, key: str | Sequence[str], tiebreak: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first in ``version_order``, then by the columns in ``tiebreak``.

    Keep ``tiebreak`` short; every column in it has to be read.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = version_order() + [F.col(c).asc_nulls_last() for c in tiebreak]
    return first_per_group(df, keys, order)


def scd2_ranges(df: DataFrame, key: str, start: str, tracked: Sequence[str]) -> DataFrame:
    """Validity ranges [start, valid_to) from dated versions; repeats of the same values are dropped.

    Values are compared as a struct and NULL-safe, because hashes skip NULLs and would take
    (NULL, 1) and (1, NULL) for the same row. Both windows share one exchange and one sort. The
    input must hold one row per key and day, which bounds a group by the number of days.
    """
    by_start = Window.partitionBy(key).orderBy(F.col(start).asc_nulls_first())
    values = F.struct(*tracked)
    marked = df.select("*", F.lag(values).over(by_start).alias("_previous"), F.row_number().over(by_start).alias("_n"))
    changes = marked.where((F.col("_n") == 1) | ~values.eqNullSafe(F.col("_previous"))).drop("_previous", "_n")
    following = F.lead(start).over(by_start)
    return changes.select("*", following.alias("valid_to")).withColumn("is_current", F.col("valid_to").isNull())


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    ts: str,
    span: DataFrame,
    span_ts: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
) -> DataFrame:
    """Left join to the version in effect at ``ts``; at most one match per left row.

    Versions are repeated for each calendar month they cover in which ``span`` (timestamps in
    ``span_ts``, at least all of the left ones) has a row, so the join runs on (key, month) plus the
    exact range. That keeps the candidates of a row down to one month of versions and spreads a hot
    key over its months, and a stray timestamp adds its own month and none between. The list of
    months is one scalar. A hot (key, month) is split by the adaptive skew join. Right columns other
    than the key are kept, without the range.

    The join is a merge join by a hint: Spark takes the repeated versions for as small as the versions
    they come from, and would send all of them through the driver as a broadcast.
    """
    seen = span.where(F.col(span_ts).isNotNull()).agg(F.collect_set(F.trunc(span_ts, "month")).alias("months")).scalar()
    kept = [c for c in right.columns if c not in (key, valid_from, valid_to)]
    first, last = F.trunc(F.col(valid_from), "month"), F.trunc(F.col(valid_to), "month")
    covered = right.select(key, valid_from, valid_to, *kept).withColumn("_seen", seen)
    months = F.filter("_seen", lambda m: (m >= first) & (last.isNull() | (m <= last)))
    versions = covered.select(
        F.col(key).alias("_key"),
        F.col(valid_from).alias("_from"),
        F.col(valid_to).alias("_to"),
        F.explode(months).alias("_version_month"),
        *kept,
    )
    rows = left.withColumn("_month", F.trunc(F.col(ts), "month"))
    condition = (
        (F.col(key) == F.col("_key"))
        & (F.col("_month") == F.col("_version_month"))
        & (F.col(ts) >= F.col("_from"))
        & ((F.col(ts) < F.col("_to")) | F.col("_to").isNull())
    )
    return rows.join(versions.hint("merge"), condition, "left").drop("_key", "_from", "_to", "_month", "_version_month")


_HISTORY = ("dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to")


def _opened(prefix: str, columns: Sequence[str], key: str, run_at: Column) -> list[Column]:
    """A version that starts with this run."""
    key_text = F.coalesce(F.col(prefix + key).cast("string"), F.lit(""))
    return [F.col(prefix + c).alias(c) for c in columns] + [
        F.md5(F.concat_ws("|", key_text, run_at.cast("string"))).alias("dbt_scd_id"),
        run_at.alias("dbt_updated_at"),
        run_at.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp").alias("dbt_valid_to"),
    ]


def scd2_snapshot(
    open_versions: DataFrame | None,
    current: DataFrame,
    key: str,
    tracked: Sequence[str],
    run_at: Column,
) -> DataFrame:
    """One run of a processing-time history: a version ends when a tracked column changes.

    Returns the rows that are open after the run (``dbt_valid_to`` NULL) and the versions the run
    closed. Keys missing from ``current`` stay open. ``open_versions`` None means the first run.
    """
    columns = current.columns
    if open_versions is None:
        return current.select(*_opened("", columns, key, run_at))

    known = set(open_versions.columns)
    old_columns = [F.col(c) if c in known else F.lit(None).cast(current.schema[c].dataType).alias(c) for c in columns]
    old = open_versions.select(F.struct(*old_columns, *_HISTORY).alias("old"), F.col(key).alias("_old_key"))
    new = current.select(F.struct(*columns).alias("new"), F.col(key).alias("_new_key"))
    pairs = old.join(new, F.col("_old_key").eqNullSafe(F.col("_new_key")), "full_outer")

    def values(side: str) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in tracked])

    opened = F.struct(*_opened("new.", columns, key, run_at))
    kept = F.struct(*[F.col(f"old.{c}").alias(c) for c in [*columns, *_HISTORY]])
    closed = F.struct(
        *[F.col(f"old.{c}").alias(c) for c in [*columns, *_HISTORY[:-1]]], run_at.alias("dbt_valid_to")
    )
    same = F.col("new").isNull() | values("old").eqNullSafe(values("new"))
    after = F.when(F.col("old").isNull(), F.array(opened)).when(same, F.array(kept)).otherwise(F.array(closed, opened))
    return pairs.select(F.inline(after))
