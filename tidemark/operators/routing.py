"""Routing of a batch's rows to their sinks in one pass.

A step states its destinations as (sink, reason, condition). :func:`route` evaluates all of them on one scan and
gives every row once per destination whose condition holds (rows may go to several, or to none), with ``sink``,
``reason`` and ``layer``; the result is written once, partitioned by sink. Whether a key is known elsewhere
is a column of the row (:func:`flag_known`), not a join per destination.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.caching import materialize
from tidemark.operators.cleaning import seen_keys

MAIN, QUARANTINE = "main", "quarantine"
TAGS = ("sink", "reason", "layer")
Destination = tuple[str, "str | Column | None", Column]


def route(df: DataFrame, layer: str, destinations: list[Destination]) -> DataFrame:
    """``df`` with ``sink``, ``reason`` and ``layer`` (both null in the main sink), a row per destination it meets.

    A condition that is null does not hold; a reason may depend on the row."""
    def entry(sink, reason, when):
        why = reason if isinstance(reason, Column) else F.lit(reason).cast("string")
        where = F.lit(None if sink == MAIN else layer).cast("string")
        return F.when(F.coalesce(when, F.lit(False)), F.struct(F.lit(sink).alias("sink"), why.alias("reason"), where.alias("layer")))

    # exploded whole and filtered after: a filter of the array is a lambda, which runs outside the generated code
    routed = df.withColumn("_to", F.explode(F.array(*[entry(*d) for d in destinations]))).where(F.col("_to").isNotNull())
    return routed.select(*df.columns, "_to.sink", "_to.reason", "_to.layer")


def flag_known(df: DataFrame, key: str, ref: DataFrame | None, ref_key: str, flag: str) -> DataFrame:
    """``df`` plus boolean ``flag``: is ``key`` among ``ref.ref_key`` (never for null, nor without a ``ref``)?

    The reference is first reduced to the batch's own keys, so the batch meets at most as many rows as it has keys."""
    if ref is None:
        return df.withColumn(flag, F.lit(False))
    there = seen_keys(df.select(F.col(key).alias("_known_key")), ref.select(F.col(ref_key).alias("_known_key")), ["_known_key"])
    joined = df.join(there.withColumn(flag, F.lit(True)), df[key] == F.col("_known_key"), "left").drop("_known_key")
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def fill_main(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Null repair of the rows that go to the main sink; quarantined rows keep what they came with."""
    main = F.col("sink") == MAIN
    return df.withColumns({c: F.when(main, F.coalesce(F.col(c), F.lit(v))).otherwise(F.col(c)) for c, v in defaults.items()})


def reject_by_key(tagged: DataFrame, keys: list[str], layer: str, name: str) -> DataFrame:
    """Batch minus accepted on the key: rows with ``_ok`` are routed to main, the others to quarantine unless an accepted
    row has their key; ``reason`` comes with the row. A null key equals none, so an accepted row without its key goes to quarantine as well.

    ``tagged`` is written once and read twice: whole, and by the rejected rows' keys."""
    tagged = materialize(tagged, name)
    good, bad = tagged.where("_ok"), tagged.where(~F.col("_ok"))
    alone = bad.join(seen_keys(bad, good, keys), keys, "left_anti").select(*tagged.columns)
    keyless = good.where(F.greatest(*[F.col(k).isNull().cast("int") for k in keys], F.lit(0)) == 1)
    keyless = keyless.withColumns({"_ok": F.lit(False), "reason": F.lit("null_key")})
    both = good.unionByName(alone).unionByName(keyless)
    return both.select(
        *[c for c in tagged.columns if c not in ("_ok", "reason")],
        F.when(F.col("_ok"), MAIN).otherwise(QUARANTINE).alias("sink"),
        F.when(~F.col("_ok"), F.col("reason")).alias("reason"), F.when(~F.col("_ok"), F.lit(layer)).alias("layer"))
