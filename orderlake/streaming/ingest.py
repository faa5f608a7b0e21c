"""Files to RAW tables exactly once, and RAW rows to facts, with Structured Streaming.

The checkpoint of a query is its list of files already loaded. Each micro-batch writes its own
partition (``_load_day``, ``_load``) with dynamic overwrite; a batch that is repeated after a failure
has the time of its first try and replaces itself. No watermark is used anywhere: late rows must not be dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderlake.session import shared_dir
from orderlake.sources import tables
from orderlake.sources.csv_files import day_path, parsed, read_table, rejected
from orderlake.sources.records import cut, read_lines
from orderlake.sources.schemas import TABLES, RawTable

# The file source leaves out files much older than the newest one it has seen. Late and copied files
# must load too, so that age is set out of reach; the checkpoint alone says what is known.
ANY_AGE = "36500d"


def _any_age(spark: SparkSession):
    return spark.readStream.option("maxFileAge", ANY_AGE)


def _start(
    rows: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, every: str | None
) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def ingest(
    spark: SparkSession,
    table: RawTable | str,
    source: str,
    raw_path: str,
    checkpoint: str,
    label: str = "",
    every: str | None = None,
) -> StreamingQuery:
    """Load the files of a folder that were not loaded before.

    Without ``every`` the query loads what is there and ends; with it (``"1 minute"``) it keeps
    looking for new files. ``label`` tells queries apart that write to the same RAW table. Records a
    tolerant table cannot take are kept beside it, in ``<raw_path>__rejects``. The driver remembers
    the files of the folder; give a folder that grows for ever a checkpoint per day, as ``ingest_day``.
    """
    table = TABLES[table] if isinstance(table, str) else table
    by_line = table.strict and not table.multi_line
    now = F.current_timestamp()
    rows = read_table(_any_age(spark), table, source) if by_line else read_lines(_any_age(spark), source, now)
    load_of = ["_load_day", "_load"]

    def save(batch: DataFrame, batch_id: int) -> None:
        load = {"_load_day": F.to_date("_loaded_at"), "_load": F.lit(f"{label}{batch_id:06d}")}
        if table.strict:
            good = batch if by_line else parsed(cut(batch), table)
            tables.overwrite_partitions(good.withColumns(load), raw_path, load_of)
            return
        # Written once, so that rows and rejects come from one reading of the files.
        staged = shared_dir(spark, "records")
        try:
            records = cut(batch)
            tables.full_refresh(records, staged)
            records = batch.sparkSession.read.schema(records.schema).parquet(staged)
            tables.overwrite_partitions(parsed(records, table).withColumns(load), raw_path, load_of)
            tables.overwrite_partitions(rejected(records).withColumns(load), f"{raw_path}__rejects", load_of)
        finally:
            tables.remove(spark, staged)

    return _start(rows, save, checkpoint, every)


def ingest_day(spark: SparkSession, lake: str, table: str, ds: str, warehouse: str) -> None:
    """Load one logical day's folder (the whole folder of a static table), skipping known files."""
    spec = TABLES[table]
    source = day_path(lake, spec, ds)
    if not tables.exists(spark, source):
        return
    part = f"{ds}-" if spec.daily else ""
    checkpoint = f"{warehouse}/_checkpoints/raw/{table}/{part or 'all'}"
    ingest(spark, spec, source, f"{warehouse}/raw/{table}", checkpoint, label=part).awaitTermination()


def follow_raw(
    spark: SparkSession,
    raw_path: str,
    merge: Callable[[DataFrame], None],
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Hand the new rows of a RAW table to ``merge`` batch by batch.

    ``merge`` has to be repeatable, as a keyed upsert is.
    """
    schema = spark.read.parquet(raw_path).schema
    rows = _any_age(spark).schema(schema).parquet(raw_path)
    return _start(rows, lambda batch, _: merge(batch), checkpoint, every)
