"""Schema versions of a source: what a later landing may change."""

from __future__ import annotations

from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)  # from narrow to wide


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The one of two types that holds every value of both; ``None`` if neither does.

    Only pairs that the parquet reader widens itself, so files of the narrow
    type are read in place."""
    if a == b:
        return a
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    if {type(a), type(b)} == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        for x, y in ((a, b), (b, a)):
            if x.scale >= y.scale and x.precision - x.scale >= y.precision - y.scale:
                return x
    return None


def evolved(table: str, current: T.StructType, landed: T.StructType) -> T.StructType:
    """The table's schema after a landing: its columns, widened where the landing
    is wider, then the landing's new columns (NULL in earlier rows)."""
    have, new = {f.name: f for f in current}, {f.name: f for f in landed}
    lost = sorted(set(have) - set(new))
    if lost:
        raise ValueError(f"Landing into {table} lacks {', '.join(lost)}")
    fields = []
    for name, field in have.items():
        kind = wider(field.dataType, new[name].dataType)
        if kind is None:
            raise ValueError(f"Landing into {table}: {name} is {new[name].dataType.simpleString()}, the table has {field.dataType.simpleString()}")
        fields.append(T.StructField(name, kind, True))
    return T.StructType(fields + [T.StructField(n, f.dataType, True) for n, f in new.items() if n not in have])
