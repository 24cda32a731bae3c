"""Changes derived from states and histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rowkind import DELETE, INSERT, UPDATE_AFTER, UPDATE_BEFORE, adds
from tidemark.operators.skew import last_before


def pair_rows(before: Column, after: Column) -> Column:
    """Row kinds of one change of one key, as an array of ``(op, row)``; nothing when equal.

    ``before`` and ``after`` are struct columns of the same type, null when absent.
    """
    def row(kind: str, image: Column) -> Column:
        return F.struct(F.lit(kind).alias("op"), image.alias("row"))

    empty = F.filter(F.array(row(INSERT, after)), lambda _: F.lit(False))
    return (
        F.when(before.eqNullSafe(after), empty)
        .when(before.isNull(), F.array(row(INSERT, after)))
        .when(after.isNull(), F.array(row(DELETE, before)))
        .otherwise(F.array(row(UPDATE_BEFORE, before), row(UPDATE_AFTER, after)))
    )


def expand_pairs(pairs: DataFrame, keys: Sequence[str], before: str = "old", after: str = "new") -> DataFrame:
    """Rows ``(keys, before, after)`` as changelog rows ``(op, keys, values)``."""
    expanded = pairs.select(*keys, F.inline(pair_rows(F.col(before), F.col(after))))
    return expanded.select("op", *keys, "row.*")


def diff_states(old: DataFrame, new: DataFrame, pk: Sequence[str]) -> DataFrame:
    """The changelog that turns one state of a keyed table into another."""
    pk = list(pk)
    values = [c for c in new.columns if c not in pk]
    left = old.select(*pk, F.struct(*values).alias("old"))
    right = new.select(*pk, F.struct(*values).alias("new"))
    return expand_pairs(left.join(right, pk, "full"), pk)


def apply_changes(state: DataFrame, changes: DataFrame, pk: Sequence[str]) -> DataFrame:
    """The state after a net changelog (at most one change per key)."""
    pk = list(pk)
    added = changes.filter(adds()).select(*state.columns)
    return state.join(changes.select(*pk).distinct(), pk, "left_anti").unionByName(added)


def changelog_of(
    history: DataFrame, pk: Sequence[str], values: Sequence[str], *, parts: int | None = None
) -> DataFrame:
    """Full before and after rows from a history of row versions.

    ``history`` holds one row per version with ``seq`` and the row kind in ``op``;
    the old image of each change is the version before it. Unchanged versions give
    nothing.
    """
    pk, values = list(pk), list(values)
    image = F.struct(adds().alias("_alive"), *values)
    versions = history.filter(F.col("op") != UPDATE_BEFORE).withColumn("_image", image)
    known = last_before(versions, pk, "seq", "_image", "_prior", parts=parts)
    bare = F.struct(*[F.col(f"_image.{c}").alias(c) for c in values])
    prior = F.struct(*[F.col(f"_prior.{c}").alias(c) for c in values])
    pairs = known.select(
        *pk,
        "seq",
        F.when(F.col("_prior._alive"), prior).alias("old"),
        F.when(F.col("_image._alive"), bare).alias("new"),
    ).filter(F.col("old").isNotNull() | F.col("new").isNotNull())
    return expand_pairs(pairs, [*pk, "seq"])
