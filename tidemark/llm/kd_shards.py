"""Sharding by a k-d tree over document metadata, in DataFrame operations only.

A node of the tree holds documents and a number of shards, total bytes over target bytes. It
is split at the weighted median (weight: bytes) along its widest dimension, the one whose range
within the node is the largest part of its range over all documents, until every leaf is one
shard of about the target. Dimensions: the text's bytes, its number of lines and its checksum.

All nodes of a level are split together. The median is found by histograms: each round counts
the bytes of about ``BINS`` equal bins between the bounds known so far, for every node in one
aggregate, and goes on within the bin that holds the median, until the bin is a single value.
The order is (dimension, checksum, bytes, id), one key after the other, so equal texts stand
side by side. Where a group of equal texts lies across the median, the cut moves to its nearer
end if that shifts no more than ``SLACK`` of the node's bytes; only heavier groups are divided,
by id. Nothing but bin counts (nodes x bins) reaches the driver.

The tree is read off as one expression, so every row gets its shard without a join; the number inside the
shard comes from a range-partitioned sort and the counts of its partitions.

Defined cases: a null text has no bytes (size 1); a null id sorts before all others; rows repeated
with their id are rows of their own, numbered in any order; fewer rows than shards leave shards empty; extra columns pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

BINS = 1024
SLACK = 0.002
DIMENSIONS = ("size", "lines", "text_crc32")


def metadata(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, lines): the narrow rows that the tree is built on."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"),
        (F.octet_length(text) - F.octet_length(F.translate(F.coalesce("text", F.lit("")), "\n", ""))).cast("bigint").alias("lines"),
    )


def _by_node(cuts: dict, default: Column) -> Column:
    out = default
    for node, value in cuts.items():
        out = F.when(F.col("node") == node, value).otherwise(out)
    return out


def _before(cut: tuple, dim: str, strict: bool) -> Column:
    """Does a row stand before the cut (value, crc, size, id) in the node's order? None is open above."""
    keys = [F.col(dim), F.col("text_crc32"), F.col("size"), F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))]
    out = F.lit(not strict)
    for key, value in reversed(list(zip(keys, cut, strict=True))):
        out = F.lit(True) if value is None else (key < value) | ((key == value) & out)
    return out


def _locate(rows: DataFrame, goals: dict[int, float], keys: dict[int, Column], fixed: dict[int, Column]):
    """For each node the value of its key at which the bytes reach the goal, and the bytes below and at it.

    ``fixed``: the rows of the node that still take part. One aggregate of bins a round.
    """
    open_, done = dict(goals), {}
    bounds = {}
    lows = rows.where(_by_node(fixed, F.lit(False))).groupBy("node").agg(
        F.min(_by_node(keys, F.lit(0))).alias("lo"), F.max(_by_node(keys, F.lit(0))).alias("hi")).collect()
    for r in lows:
        bounds[r["node"]] = (r["lo"], r["hi"])
    below = dict.fromkeys(goals, 0)
    while open_:
        # Bins are the values' leading bits: no difference of two ids can overflow.
        bits = {k: ((bounds[k][1] - bounds[k][0]) // BINS).bit_length() for k in open_}
        take = {k: fixed[k] & keys[k].between(*(F.lit(b) for b in bounds[k])) for k in open_}
        number = _by_node({k: F.shiftright(keys[k].cast("bigint"), bits[k]) for k in open_}, F.lit(0).cast("bigint"))
        counts = rows.where(_by_node(take, F.lit(False))).groupBy("node", number.alias("bin")).agg(F.sum("size").alias("bytes")).collect()
        per: dict[int, dict] = {}
        for r in counts:
            per.setdefault(r["node"], {})[r["bin"]] = r["bytes"]
        for k in list(open_):
            run = below[k]
            last = max(per[k])
            for b in sorted(per[k]):
                if run + per[k][b] >= open_[k] or b == last:
                    break
                run += per[k][b]
            lo = max(bounds[k][0], b << bits[k])
            hi = min(bounds[k][1], ((b + 1) << bits[k]) - 1)
            below[k] = run
            bounds[k] = (lo, hi)
            if lo == hi:
                done[k] = (lo, run, per[k][b])
                del open_[k]
    return done


def split_tree(points: DataFrame, shards: int) -> list:
    """The splits of the tree, level by level: (node, dimension, cut, left node, right node).

    A node is (first shard, number of shards) numbered in order of creation; the root is 0.
    """
    spans = points.agg(*(f(d).alias(f"{d}_{n}") for d in DIMENSIONS for n, f in (("lo", F.min), ("hi", F.max)))).first()
    whole = {d: max(1, (spans[f"{d}_hi"] or 0) - (spans[f"{d}_lo"] or 0)) for d in DIMENSIONS}
    parts = {0: (0, shards)}
    splits: list = []
    fresh, number = [0], 1
    while True:
        level = [k for k in fresh if parts[k][1] > 1]
        if not level:
            return splits
        rows = points.withColumn("node", leaf_of(splits))
        wanted = F.col("node").isin(level)
        stats = rows.where(wanted).groupBy("node").agg(
            F.sum("size").alias("bytes"), *(f(d).alias(f"{d}_{n}") for d in DIMENSIONS for n, f in (("lo", F.min), ("hi", F.max)))).collect()
        goals, dims, bytes_ = {}, {}, {}
        for r in stats:
            k = r["node"]
            dims[k] = max(DIMENSIONS, key=lambda d: ((r[f"{d}_hi"] - r[f"{d}_lo"]) / whole[d], -DIMENSIONS.index(d)))
            bytes_[k] = r["bytes"]
            goals[k] = r["bytes"] * (parts[k][1] // 2) / parts[k][1]
        fresh = []
        cuts = _cuts(rows, goals, dims, bytes_)
        for k in sorted(cuts):
            first, n = parts[k]
            parts[number], parts[number + 1] = (first, n // 2), (first + n // 2, n - n // 2)
            splits.append((k, dims[k], cuts[k], number, number + 1, parts[number][0], parts[number + 1][0]))
            fresh += [number, number + 1]
            number += 2


def _cuts(rows: DataFrame, goals: dict, dims: dict, bytes_: dict) -> dict:
    """For each node the tuple (value, crc, size, id) up to which rows go left; None is open above."""
    is_node = {k: F.col("node") == k for k in goals}
    value = _locate(rows, goals, {k: F.col(dims[k]).cast("bigint") for k in goals}, is_node)
    here = {k: is_node[k] & (F.col(dims[k]) == F.lit(value[k][0])) for k in goals}
    crc = _locate(rows, {k: goals[k] - value[k][1] for k in goals}, {k: F.col("text_crc32").cast("bigint") for k in goals}, here)
    here = {k: here[k] & (F.col("text_crc32") == F.lit(crc[k][0])) for k in goals}
    size = _locate(rows, {k: goals[k] - value[k][1] - crc[k][1] for k in goals}, {k: F.col("size") for k in goals}, here)
    here = {k: here[k] & (F.col("size") == F.lit(size[k][0])) for k in goals}
    out, heavy = {}, {}
    for k in goals:
        below = value[k][1] + crc[k][1] + size[k][1]
        group = size[k][2]
        before, after = goals[k] - below, below + group - goals[k]
        at = (value[k][0], crc[k][0], size[k][0])
        if min(before, after) <= SLACK * bytes_[k]:
            out[k] = (*at, None) if after <= before else (at[0], at[1], at[2] - 1, None)
        else:
            heavy[k] = at
    if heavy:
        ident = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).cast("bigint")
        got = _locate(rows, {k: goals[k] - value[k][1] - crc[k][1] - size[k][1] for k in heavy}, dict.fromkeys(heavy, ident), {k: here[k] for k in heavy})
        for k, at in heavy.items():
            v, below, own = got[k]
            goal = goals[k] - value[k][1] - crc[k][1] - size[k][1]
            if below + own - goal <= goal - below:
                out[k] = (*at, v)
            else:
                out[k] = (*at, v - 1) if v > -(1 << 63) else (at[0], at[1], at[2] - 1, None)
    return out


def leaf_of(splits: list) -> Column:
    """The node of a row below the given splits."""
    out: dict[int, Column] = {}
    for node, dim, cut, left, right, _, _ in reversed(splits):
        go = _before(cut, dim, strict=False)
        out[node] = F.when(go, out.get(left, F.lit(left))).otherwise(out.get(right, F.lit(right)))
    return out.get(0, F.lit(0))


def numbered(rows: DataFrame, shard: str = "shard") -> DataFrame:
    """``rows`` plus slot: 0, 1, 2 ... inside each shard, by id."""
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged = (rows.repartitionByRange(n, shard, "doc_id", "text_crc32").sortWithinPartitions(shard, "doc_id", "text_crc32")
              .withColumn("_part", F.spark_partition_id())
              .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    staged = materialize(staged, "kd-slots")  # one writing of the labels that both passes read
    runs = staged.groupBy(shard, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    order = Window.partitionBy(shard).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(shard, "_part", "_first", F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_base"))  # partitions x shards rows at most
    return staged.join(F.broadcast(runs), [shard, "_part"]).withColumn("slot", F.col("_base") + F.col("_at") - F.col("_first")).drop("_part", "_at", "_first", "_base")


def kd_shards(docs: DataFrame, target_bytes: int | None = None, shards: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, lines, shard, slot): as many shards as bytes / ``target_bytes``, or ``shards``."""
    points = materialize(metadata(docs), "kd-points")
    if shards is None:
        total = points.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    splits = split_tree(points, shards)
    first = {0: 0}
    for _, _, _, left, right, a, b in splits:
        first[left], first[right] = a, b
    inner = {s[0] for s in splits}
    shard = F.lit(0)
    for node, at in first.items():
        if node not in inner:
            shard = F.when(F.col("_node") == node, at).otherwise(shard)
    placed = points.withColumn("_node", leaf_of(splits)).withColumn("shard", shard.cast("int")).drop("_node")
    return numbered(placed)


def eight_shards(docs: DataFrame) -> DataFrame:
    """Contract of op7: eight shards of near equal bytes."""
    return kd_shards(docs, shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
