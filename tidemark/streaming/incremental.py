"""Incremental edges on Structured Streaming.

An edge (e.g. bronze orders → silver orders) is a file-source stream over the upstream
commit table, triggered with ``availableNow``: each run consumes exactly the commits that
arrived since the last run and stops. The stream checkpoint replaces the hand-kept marks
(exactly-once bookkeeping). A commit keeps its ``commit_version`` downstream; a replayed
micro-batch rewrites the same partitions, so the sink stays exactly-once even though the
function runs at least once.

No stream-stream join is needed: other tables a step reads (silver references, earlier
silver state) are read as batch snapshots inside ``foreachBatch``, so no watermark or
join state is kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sources import lake as L

BatchFn = Callable[[DataFrame, int], None]


def stream_commits(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Streaming read of a commit table (new commit directories become new input)."""
    r = spark.readStream.schema(L.with_commit_schema(schema))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def run_available_now(source: DataFrame, checkpoint: str, fn: BatchFn, name: str | None = None) -> None:
    """Process everything that is available now, in micro-batches, then stop."""
    w = source.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if name:
        w = w.queryName(name)
    q = w.start()
    q.awaitTermination()
    if q.exception() is not None:  # surface the failure to the caller
        raise RuntimeError(str(q.exception()))


def clean_edge(spark: SparkSession, bronze_path: str, silver_path: str,
               schema: T.StructType, clean: Callable[[DataFrame, DataFrame], object],
               checkpoint: str, silver_schema: T.StructType | None = None) -> None:
    """Bronze → silver for one table: every bronze commit that a micro-batch brings is cleaned
    against the silver commits before it and committed under the same ``commit_version``.

    The commit is read whole from the table, so a micro-batch that holds only some of its files, or
    is run again, replaces the silver commit by the same rows; batch commits stay apart from it.
    """
    silver_schema = silver_schema or schema

    def per_batch(batch: DataFrame, _batch_id: int) -> None:
        versions = sorted(r[0] for r in batch.select(L.CV).distinct().collect() if r[0] is not None)  # commits, not rows
        for v in versions:
            rows = L.change_feed(spark, bronze_path, schema, v, v).drop(L.CV).persist()
            try:
                out = clean(rows, L.read_table(spark, silver_path, silver_schema, upto=v - 1))
                L.commit_routed(out.routed, silver_path, v)
            finally:
                rows.unpersist()

    run_available_now(stream_commits(spark, bronze_path, schema), checkpoint, per_batch)
