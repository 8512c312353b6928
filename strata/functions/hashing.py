"""Row fingerprint stored with each bronze row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def record_hash_col(columns: Sequence[str]) -> Column:
    """SHA-256 (hex) of the JSON text of the row's source columns, in order.

    Follows ``to_json`` rules: NULL fields are left out of the text, so the
    hash depends on the column order and on NULL placement.
    """
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in columns])), 256)
