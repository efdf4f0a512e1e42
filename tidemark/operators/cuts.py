"""Exact quantile cuts by histogram refinement: the last row of each tile, found by counting, without sorting.

``ntile(k)`` over a whole table needs only the k - 1 rows where a tile ends. Each round counts the rows of the
intervals that still hold a wanted rank in ``BINS`` bins of equal width and goes on with the bin of the rank; an interval of
64-bit numbers is one number after seven rounds at most. Ties on the value are resolved the same way on the key. A
round is one aggregate with partial sums: nothing is sorted or moved but the counts (at most (k - 1) * BINS rows, to the
driver). A row's tile then follows from comparisons with the cuts, in whatever plan reads the rows next.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 1024
LOW, HIGH = -(2**63), 2**63 - 1


def tile_ends(rows: int, k: int) -> list[int]:
    """Rank (from 1) of the last row of tiles 1 to k - 1: the first ``rows % k`` tiles have one row more."""
    size, more = divmod(rows, k)
    return [j * size + min(j, more) for j in range(1, k)]


def refine(df: DataFrame, number: Column, targets: list[tuple[Column, int, int, int]]) -> list[tuple[int, int]]:
    """For each (rows that count, lowest, highest number, rank among them): (the number at that rank, rank among the rows of that number)."""
    state = [(of, lo, hi, rank) for of, lo, hi, rank in targets]
    while any(lo < hi for _, lo, hi, _ in state):
        open_ = {}  # targets in one interval of the same rows share its counts
        for of, lo, hi, _ in state:
            if lo < hi:
                open_.setdefault((str(of), lo, hi), (len(open_), of, -(-(hi - lo + 1) // BINS)))
        # a row lies in one interval at most: intervals are bins of one grid, or of rows that differ in value
        where, bin_ = F.lit(None).cast("int"), F.lit(None).cast("bigint")
        for (_, lo, hi), (i, of, width) in open_.items():
            inside = of & number.between(lo, hi)
            # decimals: the difference of two longs may be beyond a long
            place = F.floor((number.cast("decimal(20,0)") - F.lit(str(lo)).cast("decimal(20,0)")) / F.lit(str(width)).cast("decimal(20,0)"))
            where, bin_ = F.when(inside, i).otherwise(where), F.when(inside, place.cast("bigint")).otherwise(bin_)
        counts: dict[int, dict[int, int]] = {}
        for r in df.select(where.alias("i"), bin_.alias("b")).where("i is not null").groupBy("i", "b").count().collect():
            counts.setdefault(r["i"], {})[int(r["b"])] = r["count"]
        after = []
        for of, lo, hi, rank in state:
            if lo < hi:
                i, _, width = open_[(str(of), lo, hi)]
                for b in sorted(counts[i]):
                    if rank <= counts[i][b]:
                        lo, hi = lo + b * width, min(hi, lo + (b + 1) * width - 1)
                        break
                    rank -= counts[i][b]
            after.append((of, lo, hi, rank))
        state = after
    return [(lo, rank) for _, lo, _, rank in state]


def descending(value: Column, scale: int) -> Column:
    """A decimal as a whole number that grows as the value falls; null comes last."""
    return F.coalesce((-value * F.lit(10**scale)).cast("bigint"), F.lit(HIGH))


def ntile_cuts(df: DataFrame, number: Column, key: Column, k: int) -> list[tuple[int, int]]:
    """(number, key) of the last row of each of the tiles 1 to k - 1, rows ordered by ``number``, then ``key`` (both bigint, not null)."""
    span = df.agg(F.count("*").alias("n"), F.min(number).alias("lo"), F.max(number).alias("hi")).first()
    if not span["n"]:
        return []
    ends = tile_ends(span["n"], k)
    values = refine(df, number, [(F.lit(True), span["lo"], span["hi"], max(1, r)) for r in ends])
    tied = reduce(lambda a, b: a | b, [number == v for v, _ in values])
    spans = {r["v"]: (r["lo"], r["hi"]) for r in df.where(tied).groupBy(number.alias("v")).agg(F.min(key).alias("lo"), F.max(key).alias("hi")).collect()}  # a row per cut
    keys = refine(df, key, [(number == v, *spans[v], rank) for v, rank in values])
    # a tile before the first row (fewer rows than tiles) ends before everything
    return [(v, c) if r else (LOW, LOW) for (v, _), (c, _), r in zip(values, keys, ends, strict=True)]


def tile_of(number: Column, key: Column, cuts: list[tuple[int, int]]) -> Column:
    """1 + the number of cuts that lie before the row."""
    past = [((number > v) | ((number == v) & (key > c))).cast("int") for v, c in cuts]
    return reduce(lambda a, b: a + b, past, F.lit(1))
