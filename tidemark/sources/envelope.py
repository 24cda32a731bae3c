"""Change events: JSON records of the changes of many source tables.

A record holds the operation letter, the row image before and after the change, and
where it came from::

    {"op": "u", "before": {...}, "after": {...},
     "source": {"db": ..., "schema": ..., "table": ..., "ts_ms": ..., "lsn": ...}}

``lsn`` is the log position, unique and rising over all tables of one source.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions.rowkind import DELETE, INSERT, UPDATE_AFTER, UPDATE_BEFORE
from tidemark.functions.temporal import from_epoch_millis
from tidemark.specs import TableSpec, table_schema

# Operation letters, provenance fields and the timestamp text of events.
CREATE, READ, UPDATE, REMOVE = "c", "r", "u", "d"
SOURCE_TYPE = "struct<db:string,schema:string,table:string,ts_ms:bigint,lsn:bigint>"
TIMESTAMP_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
HEARTBEAT = "heartbeat"

_CORRUPT = "_corrupt"


def source_table(value: str | Column = "value") -> Column:
    return F.get_json_object(value, "$.source.table")


def tag_events(raw: DataFrame, value: str = "value") -> DataFrame:
    """Records taken apart once: table, operation, time, position, and both images as text.

    Records are routed, decoded and refused by these columns; an image is parsed with the
    columns of its own table only.
    """
    layout = f"op string, before string, after string, source {SOURCE_TYPE}, {_CORRUPT} string"
    head = F.from_json(value, layout, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    return raw.select(F.col(value).alias("value"), head.alias("h")).select(
        "value",
        F.col("h.source.table").alias("source_table"),
        F.col("h.source.ts_ms").alias("ts_ms"),
        (F.col(f"h.{_CORRUPT}").isNull() & F.col("h.op").isNotNull()).alias("readable"),
        F.col("h.op").alias("op"),
        F.col("h.before").alias("before"),
        F.col("h.after").alias("after"),
        from_epoch_millis("h.source.ts_ms").alias("commit_ts"),
        F.col("h.source.lsn").alias("seq"),
    )


def parse_envelope(tagged: DataFrame, spec: TableSpec) -> DataFrame:
    """Tagged records of one table with typed images, and the ``reason`` to refuse a record, null to keep it.

    Refused are records that do not parse, have an operation nobody knows, no position in
    the log, no row image or no key, and updates without the old image, which cannot be
    retracted. What is refused is never decoded too.
    """
    schema = source_schema(spec)
    rows = tagged.withColumns({"before": _image("before", spec), "after": _image("after", spec)})
    rows = rows.withColumn("reason", _refusal(spec, F.col("before"), F.col("after")))

    def plain(side: str) -> Column:
        return F.when(F.col(side).isNotNull(), F.struct(*[F.col(f"{side}.{f.name}").alias(f.name) for f in schema.fields]))

    return rows.withColumns({"before": plain("before"), "after": plain("after")})


def _image(side: str, spec: TableSpec) -> Column:
    """An image's text with the columns of its table, and what does not fit them."""
    fields = source_schema(spec).fields
    layout = ",".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", `{_CORRUPT}` string"
    return F.from_json(side, layout, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})


def _refusal(spec: TableSpec, before: Column, after: Column) -> Column:
    """Why a record of one table is refused; null if it is not."""
    op = F.col("op")
    used = F.when(op == REMOVE, before).otherwise(after)
    no_key = F.lit(False)
    for c in spec.pk:
        if c not in spec.partition_by:
            no_key = no_key | used[c].isNull() | ((op == UPDATE) & before[c].isNull())
    corrupt = ~F.col("readable") | before[_CORRUPT].isNotNull() | after[_CORRUPT].isNotNull()
    return (
        F.when(F.coalesce(corrupt, F.lit(True)), "malformed")
        .when(~op.isin(CREATE, READ, UPDATE, REMOVE), "unknown operation")
        .when(used.isNull(), "no row image")
        .when((op == UPDATE) & before.isNull(), "no old image")
        .when(no_key, "null key")
        .when(F.col("seq").isNull(), "no position")
    )


def expand_row_kinds(envelopes: DataFrame) -> DataFrame:
    """Row kinds of each record: an update gives its old and its new row.

    Images that are absent give no row.
    """
    def row(kind: str, image: str) -> Column:
        return F.struct(F.lit(kind).alias("op"), F.col(image).alias("row"))

    op = F.col("op")
    kinds = (
        F.when(op.isin(CREATE, READ), F.array(row(INSERT, "after")))
        .when(op == UPDATE, F.array(row(UPDATE_BEFORE, "before"), row(UPDATE_AFTER, "after")))
        .when(op == REMOVE, F.array(row(DELETE, "before")))
    )
    present = F.filter(kinds, lambda k: k["row"].isNotNull())
    expanded = envelopes.select("commit_ts", "seq", F.inline(present))
    return expanded.select("op", "commit_ts", "seq", "row.*")


def decode_changes(raw: DataFrame, spec: TableSpec, value: str = "value") -> DataFrame:
    """The changelog of one table from its records; those ``quarantine`` reports are left out."""
    return expand_row_kinds(parse_envelope(_tagged(raw, value), spec).filter(F.col("reason").isNull()))


def route_changes(raw: DataFrame, specs: Mapping[str, TableSpec], value: str = "value") -> dict[str, DataFrame]:
    """One changelog per declared source table. Keys of ``specs`` are source table names.

    ``raw`` holds records as text, or already tagged ones.
    """
    tagged = _tagged(raw, value)
    return {
        table: decode_changes(tagged.filter(F.col("source_table") == table), spec)
        for table, spec in specs.items()
    }


def fan_out(raw: DataFrame, specs: Mapping[str, TableSpec], value: str = "value") -> DataFrame:
    """The changes of all tables in one pass: ``routed``, ``op``, ``commit_ts``, ``seq``, ``reason``, ``value``, one struct per table.

    A record is taken apart once and its images are parsed once, with the columns of the
    table it names; the row lies in the struct of that name, the other structs are null.
    ``routed`` is that table. A refused record is one row with its text in ``value`` and the
    ``reason``, and ``routed`` null, so that written by ``routed`` every table and the quarantine
    have a folder. Heartbeats give nothing.
    """
    tagged = _tagged(raw, value).filter(~F.col("source_table").eqNullSafe(HEARTBEAT))
    table, op = F.col("source_table"), F.col("op")
    parsed = {
        f"_{side}_{name}": F.when(table == name, _image(side, spec))
        for name, spec in specs.items()
        for side in ("before", "after")
    }
    rows = tagged.withColumns(parsed)
    reason = F.when(table.isNull() | ~F.col("readable"), "malformed").when(~table.isin(*specs), "unknown table")
    for name, spec in specs.items():
        reason = reason.when(table == name, _refusal(spec, F.col(f"_before_{name}"), F.col(f"_after_{name}")))
    rows = rows.withColumn("reason", reason)

    def kind(letter: str, side: str) -> Column:
        return F.struct(F.lit(letter).alias("kind"), F.lit(side).alias("side"))

    kinds = (
        F.when(F.col("reason").isNotNull(), F.array(kind(None, None)))
        .when(op.isin(CREATE, READ), F.array(kind(INSERT, "after")))
        .when(op == UPDATE, F.array(kind(UPDATE_BEFORE, "before"), kind(UPDATE_AFTER, "after")))
        .otherwise(F.array(kind(DELETE, "before")))
    )
    rows = rows.select("*", F.inline(kinds))

    def image(name: str, spec: TableSpec) -> Column:
        def plain(side: str) -> Column:
            return F.struct(*[F.col(f"_{side}_{name}.{f.name}").alias(f.name) for f in source_schema(spec).fields])

        mine = F.col("reason").isNull() & (table == name)
        return F.when(mine, F.when(F.col("side") == "before", plain("before")).otherwise(plain("after"))).alias(name)

    refused = F.col("reason").isNotNull()
    return rows.select(
        F.when(~refused, table).alias("routed"),
        F.col("kind").alias("op"),
        "commit_ts",
        "seq",
        "reason",
        F.when(refused, F.col("value")).alias("value"),
        *[image(name, spec) for name, spec in specs.items()],
    )


def fan_out_schema(specs: Mapping[str, TableSpec]) -> StructType:
    """The columns of ``fan_out`` as they are read back, ``routed`` last."""
    meta = table_schema("op string, commit_ts timestamp, seq bigint, reason string, value string")
    images = [StructField(name, source_schema(spec)) for name, spec in specs.items()]
    return StructType([*meta.fields, *images, StructField("routed", StringType())])


def routed_rows(fanned: DataFrame, table: str) -> DataFrame:
    """The changelog of one table out of ``fan_out``."""
    return fanned.filter(F.col("routed") == table).select("op", "commit_ts", "seq", f"{table}.*")


def route_written(
    raw: DataFrame, specs: Mapping[str, TableSpec], folder: str, value: str = "value"
) -> dict[str, DataFrame]:
    """One changelog per table, by one pass over the records and one write with a folder per table."""
    fan_out(raw, specs, value).write.partitionBy("routed").parquet(folder)
    stored = raw.sparkSession.read.schema(fan_out_schema(specs)).parquet(folder)
    return {table: routed_rows(stored, table) for table in specs}


def judge(raw: DataFrame, specs: Mapping[str, TableSpec], value: str = "value") -> DataFrame:
    """Every record with its ``table`` and the ``reason`` why no table takes it, null for those decoded.

    One pass: a record's images are parsed with the columns of the table it names.
    Heartbeats, which only move time forward, have the reason ``heartbeat``.
    """
    tagged = _tagged(raw, value)
    table, readable = F.col("source_table"), F.col("readable")
    reason = (
        F.when(table.eqNullSafe(HEARTBEAT), HEARTBEAT)
        .when(table.isNull() | ~readable, "malformed")
        .when(~table.isin(*specs), "unknown table")
    )
    for name, spec in specs.items():
        reason = reason.when(table == name, _refusal(spec, _image("before", spec), _image("after", spec)))
    return tagged.select("value", table.alias("table"), reason.alias("reason"))


def quarantine(raw: DataFrame, specs: Mapping[str, TableSpec], value: str = "value") -> DataFrame:
    """Records that no table takes, with the reason; heartbeats are not reported."""
    return judge(raw, specs, value).filter(F.col("reason").isNotNull() & (F.col("reason") != HEARTBEAT))


def _tagged(raw: DataFrame, value: str) -> DataFrame:
    return raw if "source_table" in raw.columns else tag_events(raw, value)


def source_schema(spec: TableSpec) -> StructType:
    """Columns a source record carries: those stored, less the ones ingestion derives."""
    return StructType([f for f in spec.schema.fields if f.name not in spec.partition_by])


def encode_events(
    changes: DataFrame,
    table: str | Column,
    columns: list[str],
    *,
    op: str = "op",
    before: str = "before",
    after: str = "after",
    db: str = "shop",
    schema: str = "public",
) -> DataFrame:
    """Records in text form from ``(op, before, after, commit_ts, seq)``, for replaying changes."""
    source = F.struct(
        F.lit(db).alias("db"),
        F.lit(schema).alias("schema"),
        (F.lit(table) if isinstance(table, str) else table).alias("table"),
        F.unix_millis("commit_ts").alias("ts_ms"),
        F.col("seq").alias("lsn"),
    )
    body = [F.col(op).alias("op")]
    body += [F.col(c).alias(n) for c, n in ((before, "before"), (after, "after")) if c in columns]
    record = F.to_json(F.struct(*body, source.alias("source")), {"timestampFormat": TIMESTAMP_TEXT})
    return changes.select(record.cast(StringType()).alias("value"))


