"""Data checks. Each returns the failing rows; an empty result means the check holds."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once."""
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > 1)


def missing(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return df.where(F.col(column).isNull())


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Values without a parent, with their number of rows.

    Rows are counted per value first, so a value that holds most rows is one row afterwards. Values and parents then meet in an
    aggregate: a join might broadcast millions of parents' keys through the driver, whose compressed files look small.
    """
    values = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    parents = parent.select(F.col(parent_column).alias(column)).where(F.col(column).isNotNull())
    both = values.withColumn("_known", F.lit(0)).unionByName(parents.select(column, F.lit(0).cast("bigint").alias("n"), F.lit(1).alias("_known")))
    found = both.groupBy(column).agg(F.sum("n").alias("n"), F.max("_known").alias("_known")).where("_known = 0")
    return found.select(F.col(column).cast(df.schema[column].dataType).alias(column), "n")


def unexpected_values(df: DataFrame, column: str, allowed: Iterable) -> DataFrame:
    """Values outside a fixed list, with their number of rows; NULL is allowed."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col(column).isNotNull() & ~F.col(column).isin(*allowed))


def drift(expected: DataFrame, actual: DataFrame, names: tuple[str, str], measures: Sequence[str]) -> DataFrame:
    """Compare two one-row totals; returns one row with both when a measure differs."""
    both = expected.select(F.lit(names[0]).alias("_side"), *measures).unionByName(
        actual.select(F.lit(names[1]).alias("_side"), *measures)
    )
    sides = [
        F.max(F.when(F.col("_side") == side, F.col(m))).alias(f"{side}_{m}") for m in measures for side in names
    ]
    differs = F.lit(False)
    for m in measures:
        differs = differs | ~F.col(f"{names[0]}_{m}").eqNullSafe(F.col(f"{names[1]}_{m}"))
    return both.agg(*sides).where(differs)
