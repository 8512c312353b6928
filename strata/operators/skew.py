"""Hot-key detection and a skew-safe left join.

AQE splits an oversized partition on the *left* side of a left outer join,
but never the right side: one key holding a large share of the right rows
would be joined in a single task.  ``skew_left_join`` finds such keys from a
seeded sample (the table of hot keys is bounded by the sample size and is
checkpointed, then broadcast), spreads their right rows round-robin over
``_salts`` buckets, replicates only the matching left rows once per bucket,
and runs one join on (keys, salt).  Replicas whose bucket happens to hold no
right row are dropped afterwards; every hot key has right rows, so each left
row still appears once per match, which keeps left-outer semantics exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import cut_lineage

DEFAULT_ROWS_PER_TASK = 4_000_000
SAMPLES_PER_TASK = 20
# Broadcast bound for the hot-key table (key + salt count per row).
MAX_HOT_KEYS = 500_000
_SEED = 7


def rows_per_task_setting(spark) -> int:
    value = spark.conf.get("strata.join.rowsPerTask", None)
    return int(value) if value else DEFAULT_ROWS_PER_TASK


def hot_keys(df: DataFrame, cols: Sequence[str], rows_per_task: int) -> tuple[DataFrame, int] | None:
    """Keys estimated to hold more than ``2 * rows_per_task`` rows, with a
    salt count ``_salts`` (estimated rows / rows_per_task), and how many there
    are (at most rows / (2 * rows_per_task) by construction); NULL keys never
    join and are ignored.  ``None`` when there is no such key."""
    fraction = min(1.0, SAMPLES_PER_TASK / float(rows_per_task))
    per_task = max(1.0, rows_per_task * fraction)  # sampled rows that stand for one task's worth
    not_null = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    counts = (
        df.select(*cols).where(not_null).sample(False, fraction, seed=_SEED)
        .groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") >= 2 * per_task)
    )
    if not counts.take(1):
        return None
    hot = cut_lineage(counts.select(*cols, F.ceil(F.col("_n") / F.lit(per_task)).cast("int").alias("_salts")))
    return hot, hot.count()


def _eq(left: DataFrame, lcols: Sequence[str], right: DataFrame, rcols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[a] == right[b] for a, b in zip(lcols, rcols)])


def skew_left_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
                   rows_per_task: int | None = None, right_rows: int | None = None) -> DataFrame:
    """``left LEFT JOIN right ON left.a = right.b AND ...`` with hot right keys
    split over several tasks.  Column names of the two sides must differ.
    ``right_rows`` (an upper bound, e.g. from a table log) skips the sample
    when no key of the right side can be hot."""
    lcols = [a for a, _ in on]
    rcols = [b for _, b in on]
    rpt = rows_per_task or rows_per_task_setting(left.sparkSession)
    if right_rows is not None and right_rows < 2 * rpt:
        return left.join(right, _eq(left, lcols, right, rcols), "left")
    found = hot_keys(right, rcols, rpt)
    if found is None:
        return left.join(right, _eq(left, lcols, right, rcols), "left")
    hot, n_hot = found
    # broadcast only below a checked size; otherwise AQE picks the strategy
    small = F.broadcast if n_hot <= MAX_HOT_KEYS else (lambda df: df)
    hl = small(hot.select(*[F.col(c).alias(f"_hl{i}") for i, c in enumerate(rcols)], F.col("_salts").alias("_ls")))
    hr = small(hot.select(*[F.col(c).alias(f"_hr{i}") for i, c in enumerate(rcols)], F.col("_salts").alias("_rs")))
    lmark = left.join(hl, _eq(left, lcols, hl, [f"_hl{i}" for i in range(len(rcols))]), "left")
    lmark = lmark.drop(*[f"_hl{i}" for i in range(len(rcols))]).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_ls"), F.lit(1)) - 1))
    )
    rmark = right.join(hr, _eq(right, rcols, hr, [f"_hr{i}" for i in range(len(rcols))]), "left")
    rmark = rmark.drop(*[f"_hr{i}" for i in range(len(rcols))]).select(
        *right.columns,
        F.when(F.col("_rs").isNull(), F.lit(0))
        .otherwise(F.pmod(F.monotonically_increasing_id(), F.col("_rs")).cast("int")).alias("_rsalt"),
        F.lit(True).alias("_rm"),
    )
    cond = _eq(lmark, lcols, rmark, rcols) & (lmark["_salt"] == rmark["_rsalt"])
    joined = lmark.join(rmark, cond, "left")
    return joined.where(F.col("_ls").isNull() | F.col("_rm").isNotNull()).drop("_ls", "_salt", "_rsalt", "_rm")
