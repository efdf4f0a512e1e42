"""Connected components of a link table by alternating large and small stars.

Each round keeps the components and moves every node nearer to its component's smallest id:
the large star links a node's larger neighbours to its smallest one, the small star does so
with the smaller neighbours. Both are one aggregate and one join on the node; a node with very
many links is a skewed key of a plain equi-join, which adaptive execution splits. The rounds
(logarithmic in practice) are cut by tables in the shared folder, and end when the links stop changing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize


def _smallest(arcs: DataFrame) -> DataFrame:
    """Arcs (u, v) with m: the smallest of u and its v's."""
    least = arcs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return arcs.join(least, "u")


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for every node of a link the smallest id that links reach from it."""
    edges = links.where(f"`{a}` is not null and `{b}` is not null and `{a}` <> `{b}`").select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = materialize(edges, "links")
    state = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = _smallest(large)  # every v is smaller than its u
        small = down.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(down.select("u", F.col("m").alias("v")))
        edges = materialize(small.where("u <> v").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    stars = edges.groupBy("u").agg(F.min("v").alias("component"))
    roots = edges.select(F.col("v").alias("u"), F.col("v").alias("component")).distinct()
    return stars.unionAll(roots).select(F.col("u").alias("node"), "component")
