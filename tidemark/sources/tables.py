"""Reader for the driver's parquet tables (one file per table below a scale-factor dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

#: The tables that the shop's views read.
SHOP = ("customer", "supplier", "part", "orders", "lineitem", "events")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Scan one table; ``columns`` narrows the parquet ReadSchema right at the scan."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def bytes_of(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = SHOP) -> int:
    """Bytes of the files of the tables that are there."""
    total, conf = 0, spark.sparkContext._jsc.hadoopConfiguration()
    for name in names:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, name))
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return total
