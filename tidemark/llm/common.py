"""Small helpers of the training-data operators.

Task code is shipped with the job (``ship``): a cluster needs no copy of this package on
its executors. State that is worth keeping between the tasks of one Python worker (word
caches, compiled tables) lives in :func:`process_cache`; every entry is bounded by its owner.
"""

from __future__ import annotations

import hashlib
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.caching import materialize  # noqa: F401  (re-exported)
from tidemark.sources.tables import read_table

#: Separators of words, as a character class body (space and \t \n \v \f \r, nothing else).
SEPARATORS = r"\x20\x09-\x0D"
#: Texts are worked off in slices of about this many characters, so that a task's memory
#: depends on one slice and its longest single text, never on the Arrow batch.
SLICE_CHARS = 1 << 20


def ship(module: str) -> None:
    """Pickle the functions and classes of ``module`` by value into tasks."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def process_cache(owner: str) -> dict:
    """A dict that lives as long as the Python worker process works for ``owner``.

    One operator's state at a time: a worker that goes on to another operator lets the former's go.
    """
    name = "_tidemark_llm_process_cache"
    mod = sys.modules.get(name)
    if mod is None:
        mod = sys.modules[name] = types.ModuleType(name)
        mod.owner = None
    if mod.owner != owner:
        mod.owner, mod.entries = owner, {}
    return mod.entries


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents", list(columns) or None)


def slices(texts: list, limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges of ``texts`` of about ``limit`` characters, one text at least."""
    lo = size = 0
    for i, t in enumerate(texts):
        n = len(t) + 1 if t is not None else 1
        if i > lo and size + n > limit:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(texts):
        yield lo, len(texts)


def map_slices(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType, text: str) -> DataFrame:
    """``mapInArrow`` over slices of the batches, cut by the characters of column ``text``."""

    def run(batches):
        for batch in batches:
            sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
            ends = np.cumsum(np.asarray(sizes, dtype=np.int64) + 1)
            lo, base = 0, 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(ends, base + SLICE_CHARS, side="right")))
                out = fn(batch.slice(lo, hi - lo))
                if out is not None and out.num_rows:
                    yield out
                base, lo = int(ends[hi - 1]), hi
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def crc_fold(col: str = "doc_id", folds: int = 5):
    """``crc32(id as text) mod folds``; null ids give fold 0, so that nothing is learned from them."""
    return F.coalesce(F.crc32(F.col(col).cast("string")) % folds, F.lit(0))


def bounded_sample(df: DataFrame, label: str, per_class: int, key: str = "doc_id") -> list:
    """At most ``per_class`` rows of each label value, evenly drawn by a hash of ``key``.

    The counts per class are one small aggregate; then each class is thinned by its own rate
    before anything reaches the driver, and the hash order settles the exact number. The draw
    depends on keys and class counts alone, so every run sees the same rows.
    """
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect() if r[0] is not None}
    if not counts:
        return []
    h = F.pmod(F.xxhash64(F.col(key), F.lit(17)), F.lit(1 << 30))
    rate = F.lit(0.0)
    for value, n in counts.items():
        rate = F.when(F.col(label) == F.lit(value), F.lit(min(1.0, 1.25 * per_class / n + 20 / n))).otherwise(rate)
    rows = df.withColumn("_h", h).where(F.col("_h") < rate * (1 << 30)).collect()
    taken: dict = {}
    out = []
    for r in sorted(rows, key=lambda r: (r["_h"], r[key])):
        if taken.get(r[label], 0) < per_class:
            taken[r[label]] = taken.get(r[label], 0) + 1
            out.append(r)
    return out


class Shared:
    """A fitted model or table for the tasks, of a size set by parameters: broadcast as bytes
    with its classes, unpacked once per worker process."""

    def __init__(self, spark: SparkSession, value, owner: str):
        self._owner = owner
        raw = cloudpickle.dumps(value)
        self._key = ("shared", hashlib.sha256(raw).digest())
        self._raw = spark.sparkContext.broadcast(raw)

    def get(self):
        cache = process_cache(self._owner)
        if cache.get("shared_key") != self._key:  # one at a time: an older model is let go
            cache["shared_value"], cache["shared_key"] = cloudpickle.loads(self._raw.value), self._key
        return cache["shared_value"]
