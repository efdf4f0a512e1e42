"""A stated set of queries against an index in pieces, in blocks, as one sorted stream per piece.

Index pieces and blocks of queries are rows of one schema: a piece (``part`` -1) is followed by the blocks that
are to meet it, dealt by one shuffle and sorted. A task holds one piece and one block at a time, and nothing
is copied per pair but the block itself. The shuffle is queries times pieces; pieces are large for that reason.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship

ship(__name__)

BLOCK_ROWS = 256
#: Partitions of the work on pieces, at most; a task then has several, one after the other.
MOST_TASKS = 20_000


def finite_vector(col: str):
    """Is the array column present, not empty, without null, NaN and infinite components?"""
    v = F.col(col)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & ~odd, F.lit(False))


def blocks_of(queries: DataFrame, columns: list[str], flat: list[str], key: str, rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows of ``queries`` packed about ``rows`` at a time: ``part``, an array per column, arrays of ``flat`` end to end."""
    n = queries.count()
    part = F.pmod(F.xxhash64(key), F.lit(max(1, -(-n // rows))))
    packed = queries.withColumn("part", part.cast("int")).groupBy("part").agg(F.sort_array(F.collect_list(F.struct(key, *[c for c in columns + flat if c != key]))).alias("_q"))
    arrays = [F.col(f"_q.{c}").alias(c) for c in columns] + [F.flatten(F.col(f"_q.{c}")).alias(c) for c in flat]
    return packed.select("part", *arrays)


def array_of(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    """One row's list column as an array."""
    return batch.column(batch.schema.get_field_index(name))[row].values.to_numpy(zero_copy_only=False)


def meet(pieces: DataFrame, blocks: DataFrame, n_pieces: int, load: Callable, answer: Callable, schema: str) -> DataFrame:
    """``answer(load(piece row), block row)`` for every piece and block; both get (batch, row) and the answer is a batch or None.

    ``pieces`` holds column ``piece`` (0 to ``n_pieces`` - 1) and its arrays, ``blocks`` column ``part`` and its arrays; columns of the same name share a type.
    """
    dealt = blocks.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(n_pieces - 1))))
    stream = pieces.withColumn("part", F.lit(-1)).unionByName(dealt, allowMissingColumns=True)
    tasks = min(n_pieces, MOST_TASKS)

    def run(batches):
        held, piece = None, None
        for batch in batches:
            at, part = batch.schema.get_field_index("piece"), batch.schema.get_field_index("part")
            for row in range(batch.num_rows):
                number = batch.column(at)[row].as_py()
                if batch.column(part)[row].as_py() < 0:
                    held, piece = load(batch, row), number
                elif number == piece:  # a piece without rows has none to answer with
                    out = answer(held, batch, row)
                    if out is not None and out.num_rows:
                        yield out

    return stream.repartition(tasks, "piece").sortWithinPartitions("piece", "part").mapInArrow(run, schema)
