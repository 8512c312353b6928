"""Source reads and the high-water-mark extract window."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.config import SourceRegistration
from strata.functions.watermark import mark_literal, run_instant_literal


def source_frame(spark: SparkSession, reg: SourceRegistration, store=None) -> DataFrame:
    """The registered source: ``base_extract_sql`` when set, else the table.

    ``source_object`` names a table of the versioned store when one exists
    there, else a catalog table or temporary view.
    """
    if reg.base_extract_sql:
        return spark.sql(reg.base_extract_sql)
    if not reg.source_object:
        raise ValueError(f"Source {reg.source_name} has neither base_extract_sql nor source_object.")
    if store is not None and store.exists(reg.source_object):
        return store.read(reg.source_object)
    return spark.table(reg.source_object)


def run_instant(spark: SparkSession) -> str:
    """"Now" as session-zone text with its offset (so it names one instant even
    in a repeated clock hour), read once per run so every evaluation of the
    extract sees the same upper bound."""
    return spark.sql("SELECT date_format(current_timestamp(), 'yyyy-MM-dd HH:mm:ss.SSSSSSxxx') AS now").first()["now"]


def _as_text(value) -> str | None:
    if value is None:
        return None
    if isinstance(value, datetime):
        return value.isoformat(sep=" ")
    return str(value)


def window_predicates(
    df: DataFrame, reg: SourceRegistration, lower_mark: str | None, upper_instant
) -> list[Column]:
    """Bounds of an incremental extract: ``(lower_mark, upper_instant]``.

    No bounds for full loads or without an ordering column.  The lower bound
    is the stored mark typed by its tag; the upper bound is the run instant,
    applied to date/time ordering columns only (a sequence number has no
    relation to wall time).  Literals are typed to the column, so the column
    is never cast and the predicates reach the parquet scan.
    """
    if not reg.is_incremental:
        return []
    column = reg.ordering_column
    if column not in df.columns:
        raise ValueError(f"Ordering column {column} not found in source {reg.source_name}.")
    ctype = df.schema[column].dataType
    preds = []
    lower = mark_literal(lower_mark, reg.watermark_type, ctype)
    if lower is not None:
        preds.append(F.col(column) > lower)
    upper_text = _as_text(upper_instant)
    if upper_text and isinstance(ctype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        preds.append(F.col(column) <= run_instant_literal(upper_text, ctype))
    return preds


def extract_window(df: DataFrame, reg: SourceRegistration, lower_mark: str | None, upper_instant) -> DataFrame:
    preds = window_predicates(df, reg, lower_mark, upper_instant)
    if not preds:
        return df
    cond = preds[0]
    for p in preds[1:]:
        cond = cond & p
    return df.where(cond)


def high_water_mark(df: DataFrame, column: str | None) -> DataFrame:
    """One row: ``max_value`` of the ordering column (NULL if absent)."""
    if not column or column not in df.columns:
        return df.sparkSession.range(1).select(F.lit(None).cast("string").alias("max_value"))
    return df.agg(F.max(F.col(column)).alias("max_value"))


def date_range_predicate(df: DataFrame, column: str, start: str | None, end: str | None, tag: str | None) -> Column | None:
    """Replay window ``[start, end)``; either end may be open."""
    ctype = df.schema[column].dataType
    preds = []
    lo = mark_literal(start, tag, ctype)
    hi = mark_literal(end, tag, ctype)
    if lo is not None:
        preds.append(F.col(column) >= lo)
    if hi is not None:
        preds.append(F.col(column) < hi)
    if not preds:
        return None
    return preds[0] if len(preds) == 1 else preds[0] & preds[1]
