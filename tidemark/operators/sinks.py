"""Writing tables."""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.functions.rowkind import ADDS, RETRACTS
from tidemark.operators.merge import live, merge_latest
from tidemark.session import path_exists
from tidemark.specs import TableSpec, table_schema

SAVE_MODES = ("append", "overwrite", "ignore", "error")


def align_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The table's columns in order and type; those ``df`` lacks become null."""
    extra = [c for c in df.columns if c not in spec.columns]
    if extra:
        raise ValueError(f"{spec.name} has no columns {extra}")
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in spec.schema.fields
        ]
    )


def write_table(df: DataFrame, spec: TableSpec, path: str, mode: str = "append") -> None:
    """Writes rows under the table's partition columns.

    Rows of one partition value meet in a few tasks first, so a write makes few files
    per partition; AQE splits the oversized ones.
    """
    if spec.partition_by:
        df.hint("rebalance", *spec.partition_by).write.mode(mode).partitionBy(*spec.partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def overwrite_table(df: DataFrame, spec: TableSpec, path: str, *, touched_only: bool = False) -> None:
    """Replaces the table by a recomputed batch.

    With ``touched_only``, partitions without new rows stay as they are.
    """
    how = "dynamic" if touched_only else "static"
    aligned = align_columns(df, spec)
    if spec.partition_by:
        aligned = aligned.hint("rebalance", *spec.partition_by)
    writer = aligned.write.mode("overwrite").option("partitionOverwriteMode", how)
    if spec.partition_by:
        writer = writer.partitionBy(*spec.partition_by)
    writer.parquet(path)


def merge_partitions(changes: DataFrame, spec: TableSpec, path: str) -> None:
    """Merges a batch of changes into a stored last-wins table, rewriting the partitions it touches only.

    A row that moves between partitions is retracted in the old one by its old image and
    added in the new one, so both are touched. What is stored has ``op`` and ``seq`` (see
    ``merge_latest``): a removed row stays as a removal, so changes may come in any order, a
    batch that comes again changes nothing, and a partition never loses its folder.
    ``read_merged`` gives the rows.
    """
    spark = changes.sparkSession
    keys = list(spec.partition_by)
    rows = changes.filter(F.col("op").isin(*ADDS, *RETRACTS)).select("op", "seq", *spec.columns)
    stored = None
    if path_exists(spark, path):
        table = spark.read.schema(StructType([*table_schema("op string, seq bigint").fields, *spec.schema.fields])).parquet(path)
        touched = rows.select(*keys).distinct()
        unnamed = functools.reduce(operator.or_, [F.col(c).isNull() for c in keys])
        same = functools.reduce(operator.and_, [table[c].eqNullSafe(touched[c]) for c in keys])
        # Equal values prune the partitions read; those without a value are compared apart.
        stored = table.join(touched, keys, "left_semi").unionByName(
            table.filter(unnamed).join(touched.filter(unnamed), same, "left_semi")
        )
    merged = merge_latest(stored, rows, spec).select("op", "seq", *spec.columns)
    writer = merged.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).parquet(path)


def read_merged(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """The rows of a table kept by ``merge_partitions``."""
    schema = StructType([*table_schema("op string, seq bigint").fields, *spec.schema.fields])
    return live(spark.read.schema(schema).parquet(path), spec)


def write_output(
    df: DataFrame, path: str, *, mode: str = "append", checkpoint: str | None = None, **trigger
) -> StreamingQuery | None:
    """A named output: a batch in the given save mode, or an appending stream."""
    if not df.isStreaming:
        if mode not in SAVE_MODES:
            raise ValueError(f"save mode must be one of {SAVE_MODES}")
        df.write.mode(mode).parquet(path)
        return None
    if mode != "append" or checkpoint is None:
        raise ValueError("a stream appends, and needs a checkpoint folder")
    return (
        df.writeStream.outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .option("checkpointLocation", checkpoint)
        .start(path, format="parquet")
    )


def union_inserts(inserts: Iterable[DataFrame]) -> DataFrame:
    """Several inserts into one sink add up."""
    frames = iter(inserts)
    total = next(frames)
    for df in frames:
        total = total.unionByName(df)
    return total


def run_writes(source: DataFrame, writes: Iterable[Callable[[DataFrame], None]]) -> None:
    """Several sinks fed by one source.

    Each sink reads the source on its own, so that its filter and its columns reach the
    scan and nothing is held in between; keep ``source`` close to the files.
    """
    for write in writes:
        write(source)


def write_split(source: DataFrame, sinks: Mapping[str, Column], path: str, by: str = "sink") -> None:
    """Several sinks fed by one pass: a folder ``by=<name>`` below ``path`` for every sink that gets rows.

    A row goes to each sink whose condition holds, to none if none does. The source is read
    and computed once, however many sinks there are; a sink is read back by its folder.
    """
    if by in source.columns:
        raise ValueError(f"{by} is a column of the source")
    names = F.array(*[F.when(condition, F.lit(name)) for name, condition in sinks.items()])
    source.withColumn(by, F.explode(F.array_compact(names))).write.partitionBy(by).parquet(path)


def console_sink(df: DataFrame, rows: int = 20, **trigger) -> StreamingQuery | None:
    """Prints rows, for debugging."""
    if df.isStreaming:
        writer = df.writeStream.format("console").option("numRows", rows)
        return writer.trigger(**(trigger or {"availableNow": True})).start()
    df.show(rows, truncate=False)
    return None
