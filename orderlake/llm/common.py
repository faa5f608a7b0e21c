"""What the operators of this subpackage share: written intermediate tables, shipping code, reading tables."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.session import shared_dir
from orderlake.sources import tables

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` would, so that tasks can import it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    bundle = Path(tempfile.mkdtemp(prefix="ship-")) / f"{root.name}.zip"
    with zipfile.ZipFile(bundle, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, f"{root.name}/{file.relative_to(root)}")
    context.addPyFile(str(bundle))
    _SHIPPED.add(context.applicationId)


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """The frame as a table in the cluster's shared folder: lineage is cut there, and a lost executor
    only repeats the tasks that read it. ``codec`` packs tables of texts closer than the session's default."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, with a null read as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def free_name(taken, wanted: str) -> str:
    """A column name that no input column has, for an operator's own helper columns."""
    low = {c.lower() for c in taken}
    name = wanted
    while name.lower() in low:
        name += "_"
    return name


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of jobs that have ended; it notices through the driver's garbage collection."""
    gc.collect()
    spark._jvm.System.gc()


def drop_tables(frames: Iterable[DataFrame]) -> None:
    """Delete tables that ``written`` made and that no later step reads."""
    for df in frames:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            tables.remove(df.sparkSession, folder)
