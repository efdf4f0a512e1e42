"""Intermediates an operator reads more than once.

:func:`persist` keeps a frame cached inside a :func:`released` block (a pipeline step that writes its
output), until the block ends. Where no block would release it, the frame is materialized instead.

:func:`materialize` writes a frame as parquet below the shared checkpoint folder and
reads it back. Operators use it when several passes must see *the same* rows with *the
same* derived labels (a range-partition label, a position): a cache can be dropped or
rebuilt with re-sampled range bounds, a written table cannot. It also cuts lineage and
survives the loss of any executor.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame

_SCOPES: list[list[DataFrame]] = []


def persist(df: DataFrame) -> DataFrame:
    if not _SCOPES:
        return materialize(df, "held")
    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    _SCOPES[-1].append(out)
    return out


@contextmanager
def released():
    _SCOPES.append([])
    try:
        yield
    finally:
        for df in _SCOPES.pop():
            df.unpersist()


def materialize(df: DataFrame, name: str) -> DataFrame:
    from tidemark.session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
