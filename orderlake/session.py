"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings the plans are written for; all may be set on a live session.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split hot join keys even where that costs one more exchange above the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Batches for Python are bounded by bytes too: ten thousand long texts would not fit a worker.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    # Load times are instants; days and folders are those of UTC.
    "spark.sql.session.timeZone": "UTC",
    # Bloom filters prune the big side of a selective shuffle join.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created.

    This changes the caller's session, its time zone (UTC) included; every query of the package does it.
    """
    for key, value in TUNING.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, app: str = "orderlake") -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Building an expression need not record the Python line it came from.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    return tune(builder.getOrCreate())


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of an execution go when it ends, not when the driver happens to collect its garbage.

    For writes and reads to the driver; a frame that is collected twice would shuffle again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


_SCRATCH: dict[str, str] = {}


def _local_scratch(application: str) -> str:
    """A temporary folder of this machine for one application, removed when Python ends."""
    if application not in _SCRATCH:
        _SCRATCH[application] = tempfile.mkdtemp(prefix="orderlake-")
        atexit.register(shutil.rmtree, _SCRATCH[application], ignore_errors=True)
    return _SCRATCH[application]


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder all executors can reach, below the cluster's checkpoint folder.

    Only a session whose executors are threads of this process may do without that setting.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = _local_scratch(context.applicationId)
    return f"{base.rstrip('/')}/orderlake/{name}-{uuid.uuid4().hex}"
