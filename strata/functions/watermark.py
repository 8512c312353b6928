"""High-water-mark text: rendering a typed value to text and back.

The mark is stored as text next to a declared type tag.  Rendering keeps
microseconds (the value read back must not re-select the last row), and the
parsed literal is typed so the bound compares against the column without
casting it, which keeps the predicate pushable to the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type tags whose mark text is spliced unquoted (numeric tags).
NUMERIC_TAGS = frozenset({"INT", "INTEGER", "BIGINT", "LONG", "DOUBLE", "FLOAT", "DECIMAL"})


def mark_text_col(col: Column, kind: T.DataType | None = None) -> Column:
    """Spark's canonical text of the value (microseconds kept).

    An instant (``kind`` TIMESTAMP) whose text would be read back as another
    one, in the clock hour that repeats when summer time ends, also names its
    offset."""
    text = col.cast("string")
    if not isinstance(kind, T.TimestampType):
        return text
    return F.when(text.cast("timestamp") != col, F.concat(text, F.date_format(col, "xxx"))).otherwise(text)


def normalize_tag(tag: str | None) -> str:
    return (tag or "STRING").strip().upper()


def mark_literal(text: str | None, tag: str | None, column_type: T.DataType | None = None) -> Column | None:
    """Typed literal for a mark text under its declared tag.

    ``column_type`` (the ordering column's type) selects a zone-free
    ``timestamp_ntz`` literal for wall-clock columns and the column's own
    numeric type for numeric tags.
    """
    if text is None or str(text).strip() == "":
        return None
    kind = normalize_tag(tag)
    lit = F.lit(str(text).strip())
    if kind == "TIMESTAMP":
        if isinstance(column_type, T.TimestampNTZType):
            return lit.cast("timestamp_ntz")
        return lit.cast("timestamp")
    if kind == "DATE":
        return lit.cast("date")
    if kind in NUMERIC_TAGS:
        if isinstance(column_type, T.NumericType):
            return lit.cast(column_type)
        if kind in ("DOUBLE", "FLOAT"):
            return lit.cast("double")
        if kind == "DECIMAL":
            return lit.cast("decimal(38,10)")
        return lit.cast("bigint")
    return lit


def run_instant_literal(text: str, column_type: T.DataType | None) -> Column:
    """The run's upper bound ("now", fixed once per run) typed for the column."""
    if isinstance(column_type, T.TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    if isinstance(column_type, T.DateType):
        return F.lit(text).cast("timestamp").cast("date")
    return F.lit(text).cast("timestamp")
