"""Reading a keyed table as of a past moment."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rowkind import UPDATE_BEFORE, adds
from tidemark.functions.temporal import from_epoch_millis
from tidemark.operators.merge import current_state
from tidemark.operators.skew import last_before
from tidemark.specs import TableSpec


def changes_until(changelog: DataFrame, moment: int | dt.datetime | Column) -> DataFrame:
    """Changes committed at or before ``moment`` (epoch milliseconds or a timestamp)."""
    return changelog.filter(F.col("commit_ts") <= _moment(moment))


def _moment(moment: int | dt.datetime | Column) -> Column:
    if isinstance(moment, int):
        return from_epoch_millis(moment)
    return F.lit(moment) if isinstance(moment, dt.datetime) else moment


def snapshot_as_of(changelog: DataFrame, spec: TableSpec, moment: int | dt.datetime | Column) -> DataFrame:
    """The rows the table had at ``moment``; empty before its first commit."""
    return current_state(changes_until(changelog, moment), spec)


def validity(changelog: DataFrame, spec: TableSpec, *, parts: int | None = None) -> DataFrame:
    """Every row a last-wins table ever had, with the time from which and until which it stood.

    ``valid_from`` is included and ``valid_to`` is not; that of a row that still stands is null. Rows
    replaced within the same instant were never seen and are left out. Keys with many changes
    are walked in cells (see ``last_before``).
    """
    versions = changelog.filter(F.col("op") != UPDATE_BEFORE).select("op", "commit_ts", "seq", *spec.columns)
    back = versions.withColumns({"_back": -F.col("seq"), "_from": F.col("commit_ts")})
    walked = last_before(back, list(spec.pk), "_back", "_from", "valid_to", parts=parts)
    rows = walked.filter(adds() & (F.col("valid_to").isNull() | (F.col("commit_ts") < F.col("valid_to"))))
    return rows.select(*spec.columns, F.col("commit_ts").alias("valid_from"), "valid_to")


def write_history(rows: DataFrame, path: str) -> None:
    """Stores ``validity`` in the order of time, so that a look back reads only the files and row groups it needs."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "valid_from").sortWithinPartitions("valid_from")
    ordered.write.mode("overwrite").parquet(path)


def history_as_of(history: DataFrame, moment: int | dt.datetime | Column) -> DataFrame:
    """The rows that stood at ``moment``: a filter that reaches the scan, and no fold."""
    then = _moment(moment)
    standing = (F.col("valid_from") <= then) & (F.col("valid_to").isNull() | (F.col("valid_to") > then))
    return history.filter(standing).drop("valid_from", "valid_to")
