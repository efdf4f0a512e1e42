"""Bucketed tables with copy-on-write versions.

A table's rows lie in ``n`` buckets by a hash of its key. A version writes only the buckets that a change touches, into
folders of its own; its map (one small file) says for each bucket which version's folder holds it, so buckets that were
not touched keep their files and are carried over by reference. A change of few keys reads and writes the
buckets of those keys, whatever the table has grown to; older versions stay readable, and a version written again replaces itself.

    <root>/data/version=v/bucket=b/...     rows of the buckets that v wrote
    <root>/map/version=v/...               (bucket, data_version) of all buckets as of v; written after the data
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.lake import empty, folder, path_exists

MAP_SCHEMA = "bucket int, data_version int, n int"


@dataclass(frozen=True)
class Buckets:
    """A bucketed table at ``root``, keyed by ``keys``, whose rows have ``schema``.

    ``n`` is fixed for the life of a table: about the table's expected bytes over a file's (128 MB)."""

    spark: SparkSession
    root: str
    keys: tuple[str, ...]
    schema: T.StructType
    n: int = 64

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.n)).cast("int")

    def _map_path(self, version: int) -> str:
        return f"{self.root.rstrip('/')}/map/version={version}"

    def map(self, version: int) -> dict[int, int]:
        """Bucket → the version whose folder holds it (at most ``n`` entries); empty when there is no such version."""
        path = self._map_path(version)
        if version < 0 or not path_exists(self.spark, path):
            return {}
        entries = self.spark.read.schema(MAP_SCHEMA).parquet(path).collect()
        if entries and entries[0]["n"] != self.n:  # rows dealt to another number of buckets must not be mixed with these
            raise ValueError(f"{self.root} has {entries[0]['n']} buckets, not {self.n}")
        return {r["bucket"]: r["data_version"] for r in entries}

    def read(self, version: int, only: set[int] | None = None) -> DataFrame:
        """The rows as of ``version``, of all buckets or ``only`` some; an absent version has none."""
        return self._rows(self.map(version), only)

    def _rows(self, held: dict[int, int], only: set[int] | None) -> DataFrame:
        data = f"{self.root.rstrip('/')}/data"
        paths = [f"{data}/version={v}/bucket={b}" for b, v in sorted(held.items()) if only is None or b in only]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else empty(self.spark, self.schema)

    def touched(self, changes: DataFrame) -> set[int]:
        """The buckets (at most ``n``) of the keys in ``changes``."""
        return {r[0] for r in changes.select(self.bucket().alias("b")).distinct().collect()}

    def write(self, version: int, held: dict[int, int], rows: DataFrame, touched: set[int]) -> None:
        """Version ``version``: ``rows`` are all rows of the ``touched`` buckets, the others stay where ``held`` has them."""
        data = f"{self.root.rstrip('/')}/data/version={version}"
        after = {b: v for b, v in held.items() if b not in touched}
        if touched:
            (rows.select(*self.schema.fieldNames(), self.bucket().alias("bucket")).repartition(len(touched), "bucket")
             .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(data))
            after.update({int(f.split("=")[1]): version for f in folder(self.spark, data) if f.startswith("bucket=")})
        entries = self.spark.createDataFrame([(b, v, self.n) for b, v in sorted(after.items())], MAP_SCHEMA)
        entries.coalesce(1).write.mode("overwrite").parquet(self._map_path(version))

    def change(self, version: int, before: int, changes: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Version ``version`` = version ``before`` with ``merge(rows of the touched buckets, changes)`` in their place."""
        held, touched = self.map(before), self.touched(changes)
        self.write(version, held, merge(self._rows(held, touched), changes), touched)
