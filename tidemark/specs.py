"""Declared tables: schema, key, layout and merge rule."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

MERGE_RULES = ("latest", "partial-update", "aggregation")
MERGE_AGGREGATES = ("sum", "min", "max", "avg")

_PLAIN_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def table_schema(text: str) -> StructType:
    """``'name type, ...'`` as a schema; plain types need no running session."""
    pairs = [part.split() for part in text.split(",")]
    if all(len(p) == 2 and p[1].lower() in _PLAIN_TYPES for p in pairs):
        return StructType([T.StructField(name, _PLAIN_TYPES[kind.lower()]) for name, kind in pairs])
    return StructType.fromDDL(text)


@dataclass(frozen=True)
class TableSpec:
    """One keyed table.

    ``schema`` is a ``StructType`` or a Spark DDL string of the stored columns.
    ``computed`` maps virtual columns to Spark SQL expressions; they are added on
    read and never stored.
    """

    name: str
    schema: StructType
    pk: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    merge: str = "latest"
    aggregates: Mapping[str, str] = field(default_factory=dict)
    ignore_delete: bool = False
    null_overwrites: tuple[str, ...] = ()
    computed: Mapping[str, str] = field(default_factory=dict)
    event_time: str | None = None
    delay: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if isinstance(self.schema, str):
            object.__setattr__(self, "schema", table_schema(self.schema))
        for name in ("pk", "partition_by", "null_overwrites"):
            object.__setattr__(self, name, tuple(getattr(self, name)))
        if self.merge not in MERGE_RULES:
            raise ValueError(f"{self.name}: merge rule must be one of {MERGE_RULES}")
        missing = [c for c in (*self.pk, *self.partition_by) if c not in self.schema.names]
        if missing:
            raise ValueError(f"{self.name}: columns {missing} are not in the schema")
        unknown = {c: f for c, f in self.aggregates.items() if f not in MERGE_AGGREGATES}
        if unknown:
            raise ValueError(f"{self.name}: merge aggregates are {MERGE_AGGREGATES}, got {unknown}")

    @property
    def columns(self) -> list[str]:
        return list(self.schema.names)

    @property
    def values(self) -> list[str]:
        return [c for c in self.schema.names if c not in self.pk]

    def with_computed(self, df: DataFrame) -> DataFrame:
        """Adds the virtual columns, and the watermark when ``df`` is a stream."""
        if self.computed:
            df = df.withColumns({c: F.expr(e) for c, e in self.computed.items()})
        if df.isStreaming and self.event_time and self.delay:
            df = df.withWatermark(self.event_time, self.delay)
        return df
