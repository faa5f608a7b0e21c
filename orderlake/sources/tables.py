"""Parquet tables and CSV drops written by the jobs."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.session import shuffles_dropped


def exists(spark: SparkSession, path: str) -> bool:
    """True when the folder holds files or partitions, on any file system Spark can reach."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return False
    names = [entry.getPath().getName() for entry in files.listStatus(folder)]
    return any("=" in name or not name.startswith(("_", ".")) for name in names)


def state_of_files(spark: SparkSession, path: str) -> int:
    """A number for the names, lengths and times of the files and folders in a folder and one level below; another state has another number."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    # ``globStatus`` gives nothing for a folder that isn't there.
    found = [e for depth in ("*", "*/*") for e in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, depth)) or ()]
    return hash(tuple(sorted((e.getPath().toString(), e.getLen(), e.getModificationTime()) for e in found)))


def _schema_file(path: str) -> str:
    return f"{path.rstrip('/')}__schema.json"


def _stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    file = spark._jvm.org.apache.hadoop.fs.Path(_schema_file(path))
    files = file.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(file):
        return None
    stream = files.open(file)
    try:
        return T.StructType.fromJson(json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def _remember_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Columns of a table whose files may lack some; written when a write adds a column."""
    known = _stored_schema(spark, path)
    names = set() if known is None else set(known.fieldNames())
    added = [f for f in schema.fields if f.name not in names]
    if not added:
        return
    every = T.StructType([T.StructField(f.name, f.dataType) for f in [*(known or T.StructType()).fields, *added]])
    file = spark._jvm.org.apache.hadoop.fs.Path(_schema_file(path))
    stream = file.getFileSystem(spark._jsc.hadoopConfiguration()).create(file, True)
    try:
        stream.write(bytearray(every.json().encode()))
    finally:
        stream.close()


def read(spark: SparkSession, path: str) -> DataFrame:
    """A table whose later files may have more columns than its first ones.

    The columns are known from the file beside the table; only tables written otherwise have the
    footers of all their files read.
    """
    schema = _stored_schema(spark, path)
    reader = spark.read.option("mergeSchema", "true") if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that a job wrote for itself."""
    for name in (path, _schema_file(path)):
        folder = spark._jvm.org.apache.hadoop.fs.Path(name)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def is_marked(spark: SparkSession, path: str) -> bool:
    mark = spark._jvm.org.apache.hadoop.fs.Path(path)
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def mark(spark: SparkSession, path: str) -> None:
    """Leave an empty file; ``remove`` takes it away."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    file.getFileSystem(spark._jsc.hadoopConfiguration()).create(file, True).close()


def drop_partitions(spark: SparkSession, path: str, column: str, values) -> None:
    """Remove the folders of single partitions."""
    for value in values:
        remove(spark, f"{path}/{column}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}")


def full_refresh(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a whole table, columns included."""
    file = df.sparkSession._jvm.org.apache.hadoop.fs.Path(_schema_file(path))
    file.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(file, False)
    if partition_by:
        _remember_schema(df.sparkSession, path, df.schema)  # a table without rows has no file that tells its columns
        df = balanced(df, partition_by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    with shuffles_dropped(df.sparkSession):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def staged(spark: SparkSession, parts: Iterable[DataFrame], path: str) -> DataFrame:
    """Frames with the same columns as one packed table of a job's own, written one after the other."""
    schema = None
    for part in parts:
        schema = schema or part.schema
        with shuffles_dropped(part.sparkSession):
            part.write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def balanced(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Gather the rows of a partition into few files; a very large one is split over tasks."""
    return df.hint("rebalance", *partition_by)


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str], sorted_by: Sequence[str] = ()) -> None:
    """Replace exactly the partitions that ``df`` has rows for; a repeat changes nothing.

    Files whose rows are sorted by a key (``sorted_by``) take a fraction of the space, as neighbours have much in common.
    """
    _remember_columns(df, path)
    writer = _packed(df, partition_by, sorted_by).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with shuffles_dropped(df.sparkSession):
        writer.partitionBy(*partition_by).parquet(path)


def overwrite_partitions_in_turn(
    frames: Iterable[DataFrame], path: str, partition_by: list[str], sorted_by: Sequence[str] = ()
) -> None:
    """As ``overwrite_partitions`` for frames of which no two share a partition.

    They are written beside the table one after the other, and take the place of the old partitions after the last.
    """
    beside = f"{path.rstrip('/')}__new-{uuid.uuid4().hex}"
    spark = None
    try:
        for df in frames:
            spark = df.sparkSession
            _remember_columns(df, path)
            with shuffles_dropped(spark):
                _packed(df, partition_by, sorted_by).mode("append").partitionBy(*partition_by).parquet(beside)
        if spark is not None:
            _move_partitions(spark, beside, path)
    finally:
        if spark is not None:
            remove(spark, beside)


def _remember_columns(df: DataFrame, path: str) -> None:
    if exists(df.sparkSession, path) and _stored_schema(df.sparkSession, path) is None:
        _remember_schema(df.sparkSession, path, read(df.sparkSession, path).schema)
    _remember_schema(df.sparkSession, path, df.schema)


def _packed(df: DataFrame, partition_by: list[str], sorted_by: Sequence[str]) -> DataFrameWriter:
    rows = balanced(df, partition_by)
    return (rows.sortWithinPartitions(*partition_by, *sorted_by) if sorted_by else rows).write.option("compression", "zstd")


def _move_partitions(spark: SparkSession, source: str, path: str) -> None:
    """Put the partitions of one folder in the place of another's."""
    folder, table = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, path))
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(table)
    for name in [e.getPath().getName() for e in files.listStatus(folder) if e.isDirectory()]:
        old, new = (spark._jvm.org.apache.hadoop.fs.Path(p, name) for p in (table, folder))
        files.delete(old, True)
        if not files.rename(new, old):
            raise OSError(f"{new.toString()} could not be moved to {old.toString()}")
    spark.catalog.refreshByPath(path)


def write_day(df: DataFrame, path: str, ds: dt.date | str, fmt: str = "parquet") -> None:
    """Rows of one logical day into ``dt=<ds>/``; a re-run of the day replaces the day."""
    day = ds if isinstance(ds, str) else ds.isoformat()
    writer = df.withColumn("dt", F.lit(day)).write.format(fmt).mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy("dt")
    if fmt == "csv":
        writer = writer.options(header="true", quote='"', escape='"', emptyValue="")
    writer.save(path)


def write_csv_drop(df: DataFrame, path: str, day_column: str | None = None) -> None:
    """CSV files with a header row, in ``dt=`` folders when a day column is given."""
    options = {"header": "true", "quote": '"', "escape": '"', "emptyValue": "", "nullValue": ""}
    if day_column is None:
        df.write.mode("overwrite").options(**options).csv(path)
        return
    by_day = df.withColumnRenamed(day_column, "dt") if day_column != "dt" else df
    balanced(by_day, ["dt"]).write.mode("overwrite").options(**options).partitionBy("dt").csv(path)
