"""Join helpers: size-checked broadcast and key joins.

A side is broadcast only after its size has been measured against a limit; beyond the limit the
join stays a shuffle join, where AQE (``spark.sql.adaptive.skewJoin.enabled``) splits hot keys.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonalert.session import reliable_checkpoint

# Default limit for an explicit broadcast: well under executor memory, above typical dictionaries.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
_ROW_OVERHEAD = 32
_FIXED = {T.ByteType: 1, T.BooleanType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4}


def _is_fixed(dt: T.DataType) -> bool:
    return not isinstance(dt, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.UserDefinedType, T.VariantType))


def _bytes(c, dt: T.DataType):
    """Bytes of a value: texts and binaries by length, arrays, maps and structs by what they hold, ML
    vectors by their number of values. NULL counts as nothing."""
    if _is_fixed(dt):
        return F.lit(_FIXED.get(type(dt), 8)).cast("bigint")
    if isinstance(dt, (T.StringType, T.BinaryType)):
        size = F.octet_length(c) + 16
    elif isinstance(dt, T.ArrayType):
        if _is_fixed(dt.elementType):
            size = F.size(c) * _bytes(c, dt.elementType) + 16
        else:
            size = F.aggregate(c, F.lit(16).cast("bigint"), lambda a, x: a + _bytes(x, dt.elementType) + 8)
    elif isinstance(dt, T.MapType):
        size = _bytes(F.map_keys(c), T.ArrayType(dt.keyType)) + _bytes(F.map_values(c), T.ArrayType(dt.valueType))
    elif isinstance(dt, T.StructType):
        size = F.lit(8).cast("bigint")
        for f in dt.fields:
            size = size + _bytes(c.getField(f.name), f.dataType)
    elif isinstance(dt, VectorUDT):
        size = F.size(vector_to_array(c)) * 8 + 32
    else:
        size = F.octet_length(c.cast("string"))
    return F.when(c.isNull(), F.lit(0)).otherwise(size).cast("bigint")


def measured_bytes(df: DataFrame) -> int:
    """Exact-enough in-memory size of ``df``: one aggregate job over the (small) side."""
    total = F.lit(_ROW_OVERHEAD).cast("bigint")
    for k, f in enumerate(df.schema.fields):
        total = total + _bytes(F.col(f"c{k}"), f.dataType)
    row = df.toDF(*[f"c{k}" for k in range(len(df.columns))]).select(F.sum(total).alias("b")).first()
    return int(row["b"] or 0)


def checked_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES, materialize: bool = True) -> DataFrame:
    """``broadcast(df)`` when its measured size is within ``limit``, else ``df`` unchanged.

    The size is measured first, by one aggregate (a job runs when the plan is built), so a side
    that is too large is never copied. With ``materialize`` a side that passed is written to the shared
    folder, so that the join does not compute it again; plain tables need no copy.
    """
    if measured_bytes(df) > limit:
        return df
    return F.broadcast(reliable_checkpoint(df) if materialize else df)


def keep_split(df: DataFrame, members: DataFrame, key: str, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Semi-join: rows whose key is among ``members``. Runs a job to measure them."""
    return df.join(checked_broadcast(members.select(key).distinct(), limit), key, "left_semi")


def not_in(df: DataFrame, part: DataFrame, key: str, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Anti-join: rows whose key is not in ``part`` (duplicates kept, unlike EXCEPT). Where
    the rows carry their split, ``outside_split`` needs no join."""
    return df.join(checked_broadcast(part.select(key).distinct(), limit), key, "left_anti")


def outside_split(df: DataFrame, part: str, col: str = "split") -> DataFrame:
    """J2 / U2 over labelled rows: those of every other split, rows without a label included."""
    return df.filter(~F.col(col).eqNullSafe(F.lit(part)))


def attach_predictions(df: DataFrame, preds: DataFrame, key: str) -> DataFrame:
    """Predictions put back on their rows by key (never by position)."""
    return df.join(preds, key, "left")
