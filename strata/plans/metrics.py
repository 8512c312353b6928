"""Run counters computed by Spark over whole frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_counts(bronze: DataFrame, history: DataFrame, current: DataFrame) -> DataFrame:
    """One row: rows read (bronze), silver rows written (history + current)
    and gold rows written (current), from one aggregate over a tagged union."""
    tagged = (
        bronze.select(F.lit(1).alias("_b"), F.lit(0).alias("_h"), F.lit(0).alias("_c"))
        .unionByName(history.select(F.lit(0).alias("_b"), F.lit(1).alias("_h"), F.lit(0).alias("_c")))
        .unionByName(current.select(F.lit(0).alias("_b"), F.lit(0).alias("_h"), F.lit(1).alias("_c")))
    )
    b, h, c = (F.coalesce(F.sum(x), F.lit(0)).cast("bigint") for x in ("_b", "_h", "_c"))
    return tagged.agg(b.alias("rows_read"), (h + c).alias("silver_rows_written"), c.alias("gold_rows_written"))
