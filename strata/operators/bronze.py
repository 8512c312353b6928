"""Bronze landing: audit columns and a row fingerprint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.hashing import record_hash_col


def _ts(value: Column | str | None) -> Column:
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp")


def enrich_bronze(
    df: DataFrame,
    source_name: str,
    batch_id: int,
    load_mode: str,
    load_ts: Column | str | None = None,
) -> DataFrame:
    """Add ``pipeline_batch_id, bronze_load_ts, source_name, load_mode,
    record_hash``.

    ``load_ts`` is fixed per batch (pass the run instant) so that every
    evaluation of the batch carries one value.  A source column with a system
    name is replaced in place, and the hash, taken over the source column
    names, sees the replaced value.
    """
    source_columns = list(df.columns)
    stamped = df.withColumns(
        {
            "pipeline_batch_id": F.lit(int(batch_id)).cast("bigint"),
            "bronze_load_ts": _ts(load_ts),
            "source_name": F.lit(source_name),
            "load_mode": F.lit(load_mode),
        }
    )
    return stamped.withColumn("record_hash", record_hash_col(source_columns))
