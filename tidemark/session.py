"""Session helpers.

The library never builds a session for a cluster job: callers pass their own. These
helpers exist for tests, the bench and the driver contract, plus the one place that
decides where shared scratch data lives (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package assumes; a cluster session should carry them too.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # A task that writes by sink keeps a file open per sink; without it its rows are sorted by sink first.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}

# Most that one task of a lake reads, from files and from a shuffle, and from where on a hot partition is split; a session that sets less keeps its own.
TASK_BYTES = {
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
}
# Times a file's bytes that its rows are taken for when a join is planned. Spark takes the file's bytes, by the columns' default widths: for the key column of
# a written table about one byte a row, where the driver needs 50 to 90 to broadcast it. What a shuffle has measured is not changed by it.
FILE_TO_MEMORY = 32
COMPRESSION = "spark.sql.sources.fileCompressionFactor"
# Bytes of the input (compressed columns) per partition that a shuffle starts with; adaptive execution joins the small ones up to the size above.
SHUFFLE_SHARE = 4 << 20
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SIZED = "tidemark.initialPartitionNum"  # what bound_tasks has set


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide scratch folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by whoever owns the cluster (a shared filesystem or
    object store). Only when it is unset (local tests) do we pick a fresh folder under
    the system temp dir and register it as the checkpoint dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared scratch root."""
    root = shared_dir(spark).rstrip("/")
    return f"{root}/tidemark/{name}-{uuid.uuid4().hex[:12]}"


def apply_recommended_conf(spark: SparkSession) -> None:
    """Set the runtime SQL options this package relies on (idempotent)."""
    for k, v in RECOMMENDED_CONF.items():
        spark.conf.set(k, v)


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(\d+)([bkmgtp]?)[ib]*", size.strip().lower()).groups()
    return int(number) << 10 * "bkmgtp".index(unit or "b")


def bound_tasks(spark: SparkSession, input_bytes: int) -> None:
    """Let the number of tasks grow with the input, and not what a task holds (idempotent).

    A fixed number of shuffle partitions makes each of them, and the memory of its task, grow with the input. A number that
    the session itself has set for the start of its shuffles stays. Tables are not taken for small by their files' bytes, so that
    what the driver collects and broadcasts stays within the broadcast threshold."""
    for k, most in TASK_BYTES.items():
        if _bytes(spark.conf.get(k)) > _bytes(most):
            spark.conf.set(k, most)
    if float(spark.conf.get(COMPRESSION)) < FILE_TO_MEMORY:
        spark.conf.set(COMPRESSION, str(float(FILE_TO_MEMORY)))
    mine = spark.conf.get(SIZED, None)
    if spark.conf.get(INITIAL, None) != mine:
        return
    wanted = -(-input_bytes // SHUFFLE_SHARE)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(INITIAL, str(wanted))
        spark.conf.set(SIZED, str(wanted))
    elif mine is not None:
        spark.conf.unset(INITIAL)
        spark.conf.unset(SIZED)


def shuffle_partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle starts with; the number of ranges where an operator names it."""
    return int(spark.conf.get(INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions"))
