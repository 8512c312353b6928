"""Replay scope and impacted-key rewrites.

A partial rebuild works on whole entities: the keys touched by a scope are
found (a distinct projection, partially aggregated before its shuffle), all
bronze rows of those keys are re-folded, and the target table keeps its other
keys (left anti join) plus the rebuilt rows (union by name).

Key matching is plain equality by default (a NULL key never matches, so such
rows are neither rebuilt nor removed); ``null_safe=True`` matches NULL to NULL,
which the incremental fold needs to stay equal to a full rebuild.

Join strategy is left to AQE: the key side is usually small and is then
broadcast from its measured runtime size; otherwise both sides shuffle on the
keys and a hot key on the large side is split by AQE's skew handling.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def impacted_keys(scope: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key tuples of the rows in scope."""
    return scope.select(*keys).distinct()


def _key_join(left: DataFrame, keys_df: DataFrame, keys: Sequence[str], how: str, null_safe: bool) -> DataFrame:
    if not null_safe:
        return left.join(keys_df.select(*keys), list(keys), how)
    renamed = keys_df.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)])
    cond: Column = reduce(
        lambda a, b: a & b,
        [left[k].eqNullSafe(renamed[f"_key_{i}"]) for i, k in enumerate(keys)],
    )
    return left.join(renamed, cond, how)


def rows_for_keys(df: DataFrame, keys_df: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """All rows of ``df`` whose key is among ``keys_df`` (semi join)."""
    return _key_join(df, keys_df, keys, "left_semi", null_safe)


def rows_without_keys(df: DataFrame, keys_df: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """All rows of ``df`` whose key is not among ``keys_df`` (anti join)."""
    return _key_join(df, keys_df, keys, "left_anti", null_safe)


def rewrite_impacted(
    target: DataFrame | None,
    rebuilt: DataFrame,
    keys_df: DataFrame | None,
    keys: Sequence[str],
    null_safe: bool = False,
) -> DataFrame:
    """New content of a table after rebuilding the impacted keys.

    Without a target or without keys the rebuilt rows replace everything.
    The result always has the rebuilt frame's columns, in its order; columns
    the old table lacks come out NULL.
    """
    if target is None or keys_df is None:
        return rebuilt
    remaining = rows_without_keys(target, keys_df, keys, null_safe)
    combined = union_evolving(remaining, rebuilt)
    order = list(rebuilt.columns) + [c for c in combined.columns if c not in rebuilt.columns]
    return combined.select(*order)


def union_evolving(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union by column name; a column only one side has is NULL on the other."""
    return old.unionByName(new, allowMissingColumns=True)


def entity_filter(df: DataFrame, predicate: str) -> DataFrame:
    """User-supplied SQL predicate over the bronze columns."""
    if not predicate or not predicate.strip():
        raise ValueError("ENTITY replay requires entity_predicate metadata.")
    return df.where(F.expr(predicate))
