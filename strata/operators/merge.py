"""Row-level changes expressed as DataFrame rewrites.

Parquet tables have no UPDATE or MERGE, so a keyed update is a projection
with ``when(condition, new).otherwise(old)`` and an upsert is a left join of
the target to one row per source key plus an anti join for new keys; the
result is written as a new table version.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keyed_update(df: DataFrame, condition: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """``UPDATE df SET col = expr, ... WHERE condition`` as a projection.

    Assignment expressions see the row's old values.  Rows where the
    condition is NULL are left unchanged.
    """
    unknown = [c for c in assignments if c not in df.columns]
    if unknown:
        raise ValueError(f"Unknown columns in update: {unknown}")
    hit = F.coalesce(condition, F.lit(False))
    return df.select(
        *[
            (F.when(hit, assignments[c]).otherwise(F.col(c)).cast(df.schema[c].dataType) if c in assignments else F.col(c)).alias(c)
            for c in df.columns
        ]
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str],
) -> DataFrame:
    """``MERGE INTO target USING source ON keys
    WHEN MATCHED THEN UPDATE SET <update_columns> = source.<col>
    WHEN NOT MATCHED THEN INSERT *``.

    Target columns outside ``update_columns`` keep their value on a match;
    inserted rows take every column the source has (NULL for the others).
    Output has the target's columns in the target's order.  Two source rows that
    match one target row make the job fail.
    """
    keys, columns = list(keys), list(source.columns)
    # one row a source key, counted while it is gathered: a key repeated many
    # times is folded before the shuffle, and the join below adds no rows
    once = source.groupBy(*[F.col(k).alias(f"s_{k}") for k in keys]).agg(
        F.count(F.lit(1)).alias("_n"), *[F.any_value(F.col(c)).alias(f"s_{c}") for c in columns if c not in keys])
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns])
    # left join: a hot key is on the left only, where AQE can split it
    joined = t.join(once, reduce(lambda a, b: a & b, [F.col(f"t_{k}") == F.col(f"s_{k}") for k in keys]), "left")
    clash = F.raise_error(F.lit(f"Upsert: several source rows match one target row on {', '.join(keys)}"))
    # a condition, not a column: no projection on the result can leave it out
    joined = joined.where(F.when(F.col("_n") > 1, clash.cast("boolean")).otherwise(F.lit(True)))

    def kept(c: str) -> Column:
        if c not in update_columns or c in keys:
            return F.col(f"t_{c}")
        value = F.col(f"s_{c}").cast(target.schema[c].dataType) if c in columns else F.lit(None).cast(target.schema[c].dataType)
        return F.when(F.col("_n").isNotNull(), value).otherwise(F.col(f"t_{c}"))

    updated = joined.select(*[kept(c).alias(c) for c in target.columns])
    known = target.select(*keys).distinct()
    inserted = source.join(known, keys, "left_anti").select(*[
        (F.col(c) if c in columns else F.lit(None)).cast(target.schema[c].dataType).alias(c) for c in target.columns])
    return updated.union(inserted)
