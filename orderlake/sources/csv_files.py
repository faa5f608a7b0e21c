"""CSV files to RAW rows: by position, with NULL tokens, load metadata and two error modes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.functions.scalars import text_or_null, to_whole
from orderlake.sources.records import cut, read_lines
from orderlake.sources.schemas import TABLES, RawTable

_CSV = {"sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def _typed(table: RawTable, cells) -> list[Column]:
    """Cells as the table's column types; with ANSI casts a bad value raises."""
    out = []
    for name, kind in table.columns:
        cell = text_or_null(cells(name))
        value = cell if kind == "string" else to_whole(cell) if kind == "whole" else cell.cast(kind)
        out.append(value.alias(name))
    return out


def _metadata_columns(load_time: Column) -> list[Column]:
    return [F.col("_metadata.file_path").alias("_source_file"), load_time.alias("_loaded_at")]


def _reader(source, options: dict[str, str], schema):
    # Folders below the path are read too; dt= folders are known by the file path, not as a column.
    fixed = {"header": "true", "enforceSchema": "true", "recursiveFileLookup": "true"}
    return source.schema(schema).options(**fixed, **options)


def read_strict(source, table: RawTable, path, load_time: Column) -> DataFrame:
    """Facts: broken quoting or a value that does not fit its type aborts the read.

    Short rows are filled with NULL and surplus fields are left out, as for every table.
    ``source`` is ``spark.read`` or, for tables whose records are single lines, ``spark.readStream``.
    """
    if table.multi_line:
        return parsed(read_records(source, path, load_time), table)
    rows = _reader(source, _CSV | {"unescapedQuoteHandling": "RAISE_ERROR"}, table.text_schema).csv(path)
    return rows.select(*_typed(table, F.col), *_metadata_columns(load_time))


def read_records(source, path, load_time: Column | None = None) -> DataFrame:
    """The records of CSV files as text, headers left out: ``record``, ``good`` and load metadata.

    A record may span lines inside a quoted field, and a file is read by as many tasks as its size asks for.
    """
    return cut(read_lines(source, path, F.current_timestamp() if load_time is None else load_time))


def parsed(records: DataFrame, table: RawTable) -> DataFrame:
    """The good records as rows of the table; one that is not good aborts a strict table's read."""
    columns = ", ".join(f"{name} string" for name in table.names)
    record = F.col("record")
    if table.strict:
        record = F.when(F.col("good"), record).otherwise(F.raise_error(F.concat(F.lit("no record: "), F.left(record, F.lit(200)))))
    else:
        records = records.where("good")
    cells = F.from_csv(record, columns, _CSV | {"multiLine": "true"})
    rows = records.select(cells.alias("cell"), "_source_file", "_loaded_at")
    return rows.select(*_typed(table, lambda name: F.col("cell")[name]), "_source_file", "_loaded_at")


def rejected(records: DataFrame) -> DataFrame:
    """What could not be read: file, line and why."""
    quotes = F.length("record") - F.length(F.replace("record", F.lit('"'), F.lit("")))
    reason = F.when(quotes % 2 == 1, "a quote is never closed").otherwise("text beside a quoted field")
    return records.where("NOT good").select("_source_file", F.col("record").alias("line"), reason.alias("reason"), "_loaded_at")


def read_tolerant(source, table: RawTable, path, load_time: Column) -> DataFrame:
    """Dimensions: what is no record is left out (``rejected`` tells it), the rest loads."""
    return parsed(read_records(source, path, load_time), table)


def read_table(source, table: RawTable | str, path, load_time: Column | None = None) -> DataFrame:
    """One RAW table from CSV; every row of one load carries the same load time."""
    table = TABLES[table] if isinstance(table, str) else table
    read = read_strict if table.strict else read_tolerant
    return read(source, table, path, F.current_timestamp() if load_time is None else load_time)


def day_path(lake: str, table: RawTable | str, ds: dt.date | str) -> str:
    """Folder a run of day ``ds`` loads: the day's own folder, or everything for static tables."""
    table = TABLES[table] if isinstance(table, str) else table
    day = ds if isinstance(ds, str) else ds.isoformat()
    return f"{lake}/{table.name}/dt={day}" if table.daily else f"{lake}/{table.name}"


def load_day(spark: SparkSession, lake: str, table: RawTable | str, ds, load_time: Column | None = None) -> DataFrame:
    """Rows of one logical day; only that day's folder is listed and read."""
    return read_table(spark.read, table, day_path(lake, table, ds), load_time)


def load_audit(raw: dict[str, DataFrame]) -> DataFrame:
    """Row count per RAW table, sorted by table name."""
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("t"), "n") for t, df in raw.items()]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionByName(other)
    return out.orderBy("t")
