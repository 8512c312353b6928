"""Wide serving tables: a fact frame left-joined to several gold frames.

Each side is projected to the columns it contributes before the join
(column pruning reaches the scans).  Strategy is left to Catalyst/AQE: a
small side is broadcast from its measured runtime size, a large one is
shuffle-joined with AQE splitting a hot key on the fact (left) side; a hot
key on a joined (right) side is split by :func:`skew_left_join`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.skew import skew_left_join


@dataclass
class Side:
    """One left-joined side.

    ``on`` pairs (column already in the result, column of ``frame``);
    ``take`` pairs (column of ``frame``, output name).
    """

    frame: DataFrame
    on: Sequence[tuple[str, str]]
    take: Sequence[tuple[str, str]] = field(default_factory=list)
    rows: int | None = None  # known upper bound on the side's rows (skips the hot-key sample when small)


def left_join_chain(base: DataFrame, sides: Sequence[Side], skew_safe: bool = True) -> DataFrame:
    """Left-join every side in order; a side may join on columns an earlier
    side brought in.  Sides are aliased so equal names never clash."""
    result = base
    for i, side in enumerate(sides):
        prefix = f"_s{i}_"
        needed = {r for _, r in side.on} | {c for c, _ in side.take}
        right = side.frame.select(*[F.col(c).alias(prefix + c) for c in sorted(needed)])
        on = [(left_col, prefix + right_col) for left_col, right_col in side.on]
        if skew_safe:
            result = skew_left_join(result, right, on, right_rows=side.rows)
        else:
            cond = None
            for left_col, right_col in on:
                part = result[left_col] == right[right_col]
                cond = part if cond is None else cond & part
            result = result.join(right, cond, "left")
        result = result.select(
            *[c for c in result.columns if not c.startswith(prefix)],
            *[F.col(prefix + c).alias(alias) for c, alias in side.take],
        )
        # join-only columns of this side are dropped above
    return result


def greatest_of(columns: Sequence[str | Column]) -> Column:
    """Latest of several timestamps, NULLs ignored (NULL only if all are)."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    return cols[0] if len(cols) == 1 else F.greatest(*cols)


# Output columns of the sales fulfilment serving table, in order.
SALES_SERVING_COLUMNS = [
    "order_id", "customer_id", "customer_name", "customer_location", "product_id", "product_name",
    "category", "order_status", "invoice_id", "invoice_status", "shipment_id", "shipment_status",
    "warehouse_code", "order_amount", "invoice_amount", "unit_price", "order_date", "serving_effective_from",
]


def sales_fulfilment(orders: DataFrame, customer: DataFrame, product: DataFrame,
                     invoice: DataFrame, shipment: DataFrame, rows: dict[str, int | None] | None = None) -> DataFrame:
    """Serving table over the five gold snapshots (one row per order, times
    matching invoices x shipments).  ``rows`` may give known row counts of
    the joined sides (customer, product, invoice, shipment)."""
    rows = rows or {}
    base = orders.select(
        "order_id", "customer_id", "product_id", "order_status", "order_amount", "order_date",
        F.col("effective_from").alias("_o_from"),
    )
    wide = left_join_chain(
        base,
        [
            Side(customer, [("customer_id", "customer_id")],
                 [("customer_name", "customer_name"), ("location", "customer_location"), ("effective_from", "_c_from")],
                 rows.get("customer")),
            Side(product, [("product_id", "product_id")],
                 [("product_name", "product_name"), ("category", "category"), ("unit_price", "unit_price"),
                  ("effective_from", "_p_from")], rows.get("product")),
            Side(invoice, [("order_id", "order_id")],
                 [("invoice_id", "invoice_id"), ("invoice_status", "invoice_status"),
                  ("invoice_amount", "invoice_amount"), ("effective_from", "_i_from")], rows.get("invoice")),
            Side(shipment, [("order_id", "order_id")],
                 [("shipment_id", "shipment_id"), ("shipment_status", "shipment_status"),
                  ("warehouse_code", "warehouse_code"), ("effective_from", "_s_from")], rows.get("shipment")),
        ],
    )
    wide = wide.withColumn(
        "serving_effective_from", greatest_of(["_o_from", "_c_from", "_p_from", "_i_from", "_s_from"])
    )
    return wide.select(*SALES_SERVING_COLUMNS)
