"""Open-row index of an SCD2 history.

History rows are kept in three segments.  A row is *closed* once it has an end
and is not current: no later row of its key changes it again, so closed rows
are only ever appended.  Current rows that are not deleted are *live* (together
they are the current table), and the rest (deleted current rows, rows beside a
NULL ordering value) are *open*.

A batch whose rows come after everything their keys have needs the live and
open rows alone: windowing them with the new rows gives the closed versions to
append and the new last rows.  A *late* key is one where that does not hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.scd2 import LOAD_TS, live_rows

CLOSED, LIVE, OPEN = "closed", "live", "open"


def segment_column(columns: Sequence[str], delete_column: str | None, deleted_values: Sequence[str],
                   null_flag_is_live: bool) -> Column:
    """Segment of a history row."""
    current = F.coalesce(F.col("is_current"), F.lit(False))
    alive = F.coalesce(live_rows(columns, delete_column, deleted_values, null_flag_is_live), F.lit(False))
    return (F.when(~current & F.col("effective_to").isNotNull(), CLOSED)
            .when(current & alive, LIVE).otherwise(OPEN))


def order_number(column: str, kind: T.DataType) -> Column | None:
    """The ordering value as a 64-bit number that sorts alike; ``None`` for types
    that have no such number."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(column))
    if isinstance(kind, T.TimestampNTZType):
        at = F.col(column)
        seconds = (F.unix_date(at.cast("date")).cast("long") * 24 + F.hour(at)) * 3600 + F.minute(at) * 60
        return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), at) * 1_000_000).cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(column)).cast("long")
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(column).cast("long")
    return None


def late_buckets(open_rows: DataFrame, new_rows: DataFrame, keys: Sequence[str], ordering: str, bucket: Column) -> DataFrame:
    """Buckets (column ``bucket``, distinct) with a late key.

    One grouped aggregate over both sides, so a key's rows never meet in one
    task, and NULL keys match.  A key of both sides is late unless its one open
    row is current and lies before all its new rows, with no NULL among the
    ordering values and load instants.
    """
    place = F.struct(F.col(ordering).alias("o"), F.col(LOAD_TS).alias("l"))
    gap = F.col(ordering).isNull() | F.col(LOAD_TS).isNull()

    def side(df: DataFrame, old: bool) -> DataFrame:
        current = F.col("is_current") if old else F.lit(True)
        return df.select(*keys, bucket.alias("bucket"), place.alias("place"), gap.alias("gap"), current.alias("current"),
                         F.lit(old).alias("old"))

    per_key = side(open_rows, True).union(side(new_rows, False)).groupBy("bucket", *keys).agg(
        F.count_if("old").alias("n_old"), F.count_if(~F.col("old")).alias("n_new"),
        F.max(F.when(F.col("old"), F.col("place"))).alias("last"),
        F.min(F.when(~F.col("old"), F.col("place"))).alias("first"),
        F.bool_or("gap").alias("gap"), F.bool_and("current").alias("current"))
    late = (F.col("n_old") > 1) | F.col("gap") | ~F.col("current") | (F.col("last") >= F.col("first"))
    return per_key.where((F.col("n_old") > 0) & (F.col("n_new") > 0) & late).select("bucket").distinct()
