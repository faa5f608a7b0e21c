"""Aggregates that are kept up to date from signed rows: what a key had before subtracts, what it has now adds.

An upsert tells its keys' old rows with ``_sign`` -1 and their new ones with 1 (``upsert(changes=)``). Sums and counts of such rows are
what an aggregate changes by, whatever happened to a key: it came, moved to another group, was corrected or was sent
again. Averages, percentiles and the like are computed from stored sums and counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.operators.upsert import distinct_values, in_partitions
from orderlake.session import shared_dir
from orderlake.sources import tables

SIGN = "_sign"


def signed(rows: DataFrame) -> DataFrame:
    """All rows of a table, as if they had just come."""
    return rows.withColumn(SIGN, F.lit(1))


def rows_in() -> Column:
    return F.sum(F.col(SIGN).cast("bigint"))


def count_of(condition: Column) -> Column:
    return F.sum(F.when(condition, F.col(SIGN)).otherwise(0).cast("bigint"))


def sum_of(value: Column) -> Column:
    """The sum of a value, with 0 for NULL; count the values that aren't NULL beside it where that matters."""
    return F.sum(F.coalesce(value, F.lit(0)) * F.col(SIGN))


def dealt(key: str, parts: int = 16) -> Column:
    """A partition column for aggregates that have no calendar: the key's hash."""
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def refresh(
    spark: SparkSession, path: str, delta: DataFrame, keys: Sequence[str], rows: str, part: str, rebuild: bool = False
) -> DataFrame:
    """Add signed sums to a stored table of sums and return it.

    ``delta`` has the keys, the partition column ``part`` (a function of the keys) and sums, of which ``rows`` counts rows: a
    group that has none left goes. Only the partitions that the delta touches are read and rewritten. With ``rebuild`` the
    delta is all there is.
    """
    if rebuild or not tables.exists(spark, path):
        tables.full_refresh(delta.where(F.col(rows) != 0), path, [part])
        return tables.read(spark, path)
    staged = shared_dir(spark, "delta")
    try:
        tables.full_refresh(delta, f"{staged}/in")
        delta = spark.read.schema(delta.schema).parquet(f"{staged}/in")
        touched = set(distinct_values(delta, part))
        if touched:
            known = tables.read(spark, path).where(in_partitions(part, touched))
            sums = [c for c in delta.columns if c not in (*keys, part)]
            both = known.select(*delta.columns).unionByName(delta)
            after = both.groupBy(part, *keys).agg(*[F.sum(c).alias(c) for c in sums]).where(F.col(rows) != 0)
            after = after.select(*[F.col(f.name).cast(f.dataType) for f in delta.schema.fields])
            tables.full_refresh(after, f"{staged}/out")
            after = spark.read.schema(delta.schema).parquet(f"{staged}/out")
            tables.overwrite_partitions(after, path, [part])
            tables.drop_partitions(spark, path, part, touched - set(distinct_values(after, part)))
    finally:
        tables.remove(spark, staged)
    return tables.read(spark, path)
