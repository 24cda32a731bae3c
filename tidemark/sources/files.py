"""Changelogs, bootstrap files, relational tables and inline rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.rowkind import INSERT
from tidemark.functions.temporal import from_epoch_millis
from tidemark.operators.merge import fold_latest
from tidemark.session import path_exists
from tidemark.specs import TableSpec, table_schema


def changelog_schema(spec: TableSpec) -> StructType:
    meta = table_schema("op string, commit_ts timestamp, seq bigint")
    return StructType(meta.fields + spec.schema.fields)


def read_changes(spark: SparkSession, spec: TableSpec, path: str, *, files_per_batch: int | None = None) -> DataFrame:
    """A keyed table as a stream: what it holds now, then its changes."""
    reader = spark.readStream.schema(changelog_schema(spec))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return spec.with_computed(reader.parquet(path))


def read_changelog(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """The whole changelog of a keyed table, as a batch."""
    return spec.with_computed(spark.read.schema(changelog_schema(spec)).parquet(path))


def read_with_contents(
    spark: SparkSession, spec: TableSpec, path: str, start: str, *, position: str = "seq"
) -> DataFrame:
    """A last-wins table as a stream: the rows it held when the stream first began, then every later change.

    The rows are folded once and written to the folder ``start``, with the ``position`` up to
    which they go; changes after it follow from the changelog at ``path``, without gap or
    overlap. A stream that is started again with the same ``start`` goes on from there. Once a
    position has been read none before it may be written. A row of the start is an insert
    with the position of its last change.
    """
    log = spark.read.schema(changelog_schema(spec)).parquet(path)
    if not path_exists(spark, f"{start}/upto/_SUCCESS"):
        upto = log.agg(F.coalesce(F.max(position), F.lit(-1)).cast("bigint").alias("upto")).first()["upto"]
        held = fold_latest(log.filter(F.col(position) <= upto), spec, keep=("commit_ts", "seq"))
        rows = held.withColumn("op", F.lit(INSERT)).select("op", "commit_ts", "seq", *spec.columns)
        rows.write.mode("overwrite").parquet(f"{start}/contents")
        spark.range(1).select(F.lit(upto).alias("upto")).write.mode("overwrite").parquet(f"{start}/upto")
    upto = spark.read.schema("upto bigint").parquet(f"{start}/upto").first()["upto"]
    schema = changelog_schema(spec)
    contents = spark.readStream.schema(schema).parquet(f"{start}/contents")
    later = spark.readStream.schema(schema).parquet(path).filter(F.col(position) > upto)
    return spec.with_computed(contents.unionByName(later))


def read_bootstrap(spark: SparkSession, spec: TableSpec, path: str, fmt: str = "csv") -> DataFrame:
    """Initial rows of a table as inserts older than any change.

    A line that does not fit the schema ends the load with an error: half a table is no
    start to build on.
    """
    reader = spark.read.schema(spec.schema).option("mode", "FAILFAST")
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path).select(
        F.lit(INSERT).alias("op"),
        from_epoch_millis(0).alias("commit_ts"),
        F.lit(0).cast("bigint").alias("seq"),
        *spec.columns,
    )


def load_bootstrap(spark: SparkSession, spec: TableSpec, path: str, target: str, fmt: str = "csv") -> bool:
    """Writes the initial rows to the changelog at ``target``, unless it has rows already."""
    try:
        if not spark.read.parquet(target).isEmpty():
            return False
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    writer = read_bootstrap(spark, spec, path, fmt).write.mode("append")
    if spec.partition_by:
        writer = writer.partitionBy(*spec.partition_by)
    writer.parquet(target)
    return True


def jdbc_options(
    url: str,
    table: str,
    *,
    user: str | None = None,
    password: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options; a partition column with bounds splits the scan over tasks."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    given = (partition_column, bounds, partitions)
    if any(g is not None for g in given):
        if any(g is None for g in given):
            raise ValueError("a split scan needs partition_column, bounds and partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kwargs)).load()


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)
