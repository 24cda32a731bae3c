"""Joins of keyed tables and of their changelogs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rowkind import UPDATE_AFTER, UPDATE_BEFORE, adds
from tidemark.operators.changes import apply_changes, diff_states
from tidemark.operators.skew import heavy_keys, last_before
from tidemark.session import written

_END = 2**63 - 1


def join_current(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join of two current states; adaptive execution broadcasts a small side and splits skewed keys."""
    return left.join(right, list(on), how)


def join_changes(
    left: DataFrame,
    left_changes: DataFrame,
    right: DataFrame,
    right_changes: DataFrame,
    on: Sequence[str],
    left_pk: Sequence[str],
    right_pk: Sequence[str],
) -> DataFrame:
    """Changelog of an inner join, from two states and the net changes of a batch.

    ``right`` is keyed by ``on``; changes hold at most one row that adds per key, and a
    removal needs no more than its key. Joined again are the rows of ``left`` that changed,
    under their old and new ``on``, and those whose ``on`` changed in ``right``. Each state is
    read once, by a semi-join with the changes; what is found is written out, and all
    else costs what the batch touches.
    """
    on, left_pk, right_pk = list(on), list(left_pk), list(right_pk)
    moved = left_changes.select(*left_pk).distinct().withColumn("_moved", F.lit(True))
    met = right_changes.select(*on).distinct().withColumn("_met", F.lit(True))
    before = left.join(moved, left_pk, "left").join(met, on, "left").filter("_moved or _met")
    before = written(before.select(*left.columns), "near-left")
    after = apply_changes(before, left_changes, left_pk)
    needed = before.select(*on).unionByName(after.select(*on)).distinct()
    known = written(right.join(needed, on, "left_semi"), "near-right")
    renewed = apply_changes(known, right_changes, right_pk)
    return diff_states(before.join(known, on), after.join(renewed, on), left_pk)


def next_position(
    changes: DataFrame,
    pk: Sequence[str],
    output: str,
    *,
    heavy: Sequence[int] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Adds the ``seq`` of the next change of the same key; the end of time for the last one."""
    walked = last_before(
        changes.withColumn("_back", -F.col("seq")), pk, "_back", "seq", "_next", heavy=heavy, parts=parts
    )
    return walked.withColumn(output, F.coalesce("_next", F.lit(_END))).drop("_back", "_next")


def last_match(
    facts: DataFrame,
    dims: DataFrame,
    on: Sequence[str],
    pk: Sequence[str],
    values: Sequence[str],
    *,
    parts: int | None = None,
) -> DataFrame:
    """What the changelog join of two changelogs last emitted for each version of a fact.

    A fact version meets every dimension version alive at some moment of its own life;
    the latest meeting wins, so each fact version gives at most one row, whatever the
    number of pairs. The row is an update at the position of that meeting. A dimension
    row deleted meanwhile has still been met; one deleted before has not.

    ``seq`` must be comparable between both changelogs.
    """
    on, pk, values = list(on), list(pk), list(values)
    moves = facts.filter(F.col("op") != UPDATE_BEFORE).select("op", "seq", *{*pk, *on})
    spans = next_position(moves, pk, "_until", parts=parts).filter(adds())
    known = dims.filter(F.col("op") != UPDATE_BEFORE).select("op", "seq", *on, *values)
    lives = next_position(known, on, "_gone", parts=parts).filter(adds())
    # No key has more lives than changes, so the changes tell where the meeting is crowded.
    heavy = heavy_keys(facts.select(*on).unionByName(dims.select(*on)), on, parts)
    return meet(spans, lives, on, pk, values, heavy=heavy, parts=parts)


def meet(
    spans: DataFrame,
    lives: DataFrame,
    on: Sequence[str],
    pk: Sequence[str],
    values: Sequence[str],
    *,
    heavy: Sequence[int] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Last overlap of fact lives ``[seq, _until)`` with dimension lives ``[seq, _gone)``."""
    on, pk, values = list(on), list(pk), list(values)
    image = F.struct(F.col("seq").alias("from"), F.col("_gone").alias("gone"), *values)
    writers = lives.select(*on, F.col("seq").alias("_pos"), image.alias("_life"))
    reads = spans.select(
        *on, *[c for c in pk if c not in on], F.col("seq").alias("_from"), (F.col("_until") - 1).alias("_pos")
    )
    rows = reads.withColumn("_order", F.lit(1)).unionByName(
        writers.withColumn("_order", F.lit(0)), allowMissingColumns=True
    )
    if heavy:
        # Cutting heavy keys takes more than one pass over lives that were hard to get.
        rows = written(rows, "lives")
    met = last_before(rows, on, "_pos", "_life", "_met", ties=["_order"], heavy=heavy, parts=parts)
    met = met.filter((F.col("_order") == 1) & (F.col("_met.gone") > F.col("_from")))
    return met.select(
        F.lit(UPDATE_AFTER).alias("op"),
        F.greatest("_from", "_met.from").alias("seq"),
        *pk,
        *[F.col(f"_met.{v}").alias(v) for v in values],
    )
