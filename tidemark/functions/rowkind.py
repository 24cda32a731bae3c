"""Row kinds of a changelog.

A changelog row carries ``op`` (one of the four kinds), ``commit_ts`` and ``seq``;
an update is a ``-U`` row with the old values and a ``+U`` row with the new ones,
both under the same ``seq``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, StringType, StructType
from pyspark.sql import types as T

# Row kinds, and the operation letters of change events.
INSERT = "+I"
UPDATE_BEFORE = "-U"
UPDATE_AFTER = "+U"
DELETE = "-D"
ADDS = (INSERT, UPDATE_AFTER)
RETRACTS = (UPDATE_BEFORE, DELETE)
META = ("op", "commit_ts", "seq")

_FIXED = (
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
    T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType,
)


def adds(op: str | Column = "op") -> Column:
    return _col(op).isin(*ADDS)


def order_key(seq: str | Column = "seq", op: str | Column = "op") -> Column:
    """Position of a row in its key's history: by ``seq``, old image before new one."""
    return _col(seq).cast("bigint") * 2 + adds(op).cast("bigint")


def signed(value: str | Column, op: str | Column = "op") -> Column:
    """The value as an addition or a retraction."""
    value = _col(value)
    return F.when(adds(op), value).otherwise(-value)


def is_fixed_width(dtype: DataType) -> bool:
    """Whether Spark can keep the type in a hash aggregation buffer."""
    return isinstance(dtype, _FIXED) or isinstance(dtype, DecimalType)


def all_fixed_width(schema: StructType, columns: list[str]) -> bool:
    return all(is_fixed_width(schema[c].dataType) for c in columns)


def is_integral(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() in ("byte", "short", "integer", "long")


def byte_size(schema: StructType, columns: list[str]) -> Column:
    """Estimated bytes of one row of ``columns``."""
    total: Column = F.lit(16)
    for name in columns:
        if isinstance(schema[name].dataType, StringType):
            total = total + F.coalesce(F.octet_length(name), F.lit(0)) + 16
        elif is_fixed_width(schema[name].dataType):
            total = total + 8
        else:
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0))
    return total


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
