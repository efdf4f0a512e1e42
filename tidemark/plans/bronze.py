"""Landing layer: split a landed batch on its keys and gate it on the share of bad rows.

Per-table rules (fixed, they must match the published behaviour):
  customers        accepted: customer_id present          quarantined: it is null
  products         accepted: pid present                  quarantined: it is null; gate is strict (>)
  orders           accepted: oid present                  quarantined: it is null
  order_items      accepted: order_item_id or order_id present; quarantined: either is null
                   (a half-null row is in both)
  order_status_log accepted: log_id or order_id present;  quarantined: log_id null and order_id
                   present (an all-null row is in neither)
  inventory        accepted: inventory_id and product_id present; quarantined: either is null
A row whose file or line could not be parsed is quarantined, whatever its keys. A batch is rejected when bad >= 30 % of its rows (products: > 30 %); a rejected batch
lands nothing but still counts as a (empty) commit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.caching import materialize
from tidemark.operators.quality import SplitRule, all_present, any_missing, any_present, quality_gate
from tidemark.operators.routing import MAIN, QUARANTINE, TAGS, route
from tidemark.schemas import CORRUPT

MAX_BAD_SHARE = 0.3
LAYER = "bronze"


@dataclass(frozen=True)
class TableRule:
    split: SplitRule
    strict: bool = False


def rules() -> dict[str, TableRule]:
    return {
        "customers": TableRule(SplitRule(all_present("customer_id"), any_missing("customer_id"))),
        "products": TableRule(SplitRule(all_present("pid"), any_missing("pid")), strict=True),
        "orders": TableRule(SplitRule(all_present("oid"), any_missing("oid"))),
        "order_items": TableRule(SplitRule(any_present("order_item_id", "order_id"),
                                           any_missing("order_item_id", "order_id"))),
        "order_status_log": TableRule(SplitRule(any_present("log_id", "order_id"),
                                                F.col("log_id").isNull() & F.col("order_id").isNotNull())),
        "inventory": TableRule(SplitRule(all_present("inventory_id", "product_id"),
                                         any_missing("inventory_id", "product_id"))),
    }


@dataclass
class Landed:
    gate: DataFrame          # a row per batch: rows, bad_rows, passed (and the batch's column)
    routed: DataFrame        # rows with sink, reason, layer (none of a batch that the gate rejects)

    @property
    def accepted(self) -> DataFrame:
        return self.routed.where(F.col("sink") == MAIN).drop(*TAGS)

    @property
    def quarantined(self) -> DataFrame:
        return self.routed.where(F.col("sink") == QUARANTINE).drop(*TAGS)


def corrupt(batch: DataFrame) -> Column:
    """Did the reader give up on this row's file or line?"""
    return F.col(CORRUPT).isNotNull() if CORRUPT in batch.columns else F.lit(False)


def bad_row(batch: DataFrame, table: str) -> Column:
    """What the gate counts: rows for quarantine."""
    return F.coalesce(rules()[table].split.invalid, F.lit(False)) | corrupt(batch)


def split(batch: DataFrame, table: str) -> DataFrame:
    """The batch routed to its sinks, without the gate: one pass, overlapping rules give a row to both."""
    rule, lost = rules()[table].split, corrupt(batch)
    routed = route(batch, LAYER, [
        (MAIN, None, rule.valid & ~lost),
        (QUARANTINE, F.when(lost, "corrupt_record").otherwise("null_key"), rule.invalid | lost),
    ])
    return routed


def ingest(batch: DataFrame, table: str, max_bad_share: float = MAX_BAD_SHARE, by: list[str] | None = None) -> Landed:
    """Split + gate. ``by``: the columns that tell the batches apart (each has its own verdict); without them ``batch`` is one.

    The verdicts of ``by`` (a row per batch) are written when the plan is made and sent to the rows: a shuffled join on so few keys
    would move the whole table, most of it into a task per batch, each time the rows are read."""
    rule = rules()[table]
    counted = SplitRule(rule.split.valid, bad_row(batch, table))
    gate = quality_gate(batch, counted, max_bad_share, rule.strict, by or [])
    routed = split(batch, table)
    if by:
        gate = materialize(gate, f"gate-{table}")
        routed = routed.join(F.broadcast(gate.where("passed").select(*by)), by, "left_semi")
    else:
        routed = routed.where(gate.select("passed").scalar())
    return Landed(gate, routed)
