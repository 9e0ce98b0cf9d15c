"""Plan helpers shared by operators: broadcasts of a measured size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows and estimated bytes up to which a side may be broadcast once it has been counted.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def _width(c: Column, t: T.DataType) -> Column:
    """Estimated bytes of a value: 8 for a plain one, the length of text, the items of a collection."""
    if isinstance(t, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)).cast("long") + 8
    if isinstance(t, T.StructType):
        return sum((_width(c[f.name], f.dataType) for f in t.fields), F.lit(8).cast("long"))
    if isinstance(t, T.ArrayType):
        if isinstance(t.elementType, (T.StringType, T.BinaryType, T.StructType, T.ArrayType, T.MapType)):
            return F.aggregate(F.coalesce(c, F.array().cast(t)), F.lit(8).cast("long"), lambda a, x: a + _width(x, t.elementType))
        return F.coalesce(F.array_size(c), F.lit(0)).cast("long") * 8 + 8
    if isinstance(t, T.MapType):
        return _width(F.map_keys(c), T.ArrayType(t.keyType)) + _width(F.map_values(c), T.ArrayType(t.valueType))
    return F.lit(8).cast("long")


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast only if it was measured and has at most ``max_rows`` rows of about ``max_bytes`` bytes in all;
    otherwise unchanged, so that the join shuffles. Call it on something cheap to read (a checkpoint, a reused aggregate)."""
    width = sum((_width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(8).cast("long"))
    n, size = df.limit(max_rows + 1).select(width.alias("w")).agg(F.count(F.lit(1)), F.coalesce(F.sum("w"), F.lit(0))).first()
    return F.broadcast(df) if n <= max_rows and size <= max_bytes else df
