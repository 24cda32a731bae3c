"""Keyed tables: how the changes of one key combine into its row.

Every rule is one aggregation on the key, so changes are combined before they are
shuffled and a frequently changed key costs one buffer per task. The same rule folds a
whole changelog or merges a batch into a state. A state keeps the log positions of what
it holds, removed keys included, so that batches may come in any order; ``live`` gives
its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rowkind import (
    DELETE,
    INSERT,
    UPDATE_AFTER,
    adds,
    all_fixed_width,
    is_integral,
    order_key,
    signed,
)
from tidemark.specs import TableSpec

ORDER_PREFIX = "_at_"
LIVE = "live_rows"
COUNT = "_n_"
EXTREMES = ("min", "max")


def current_state(changelog: DataFrame, spec: TableSpec) -> DataFrame:
    """The current rows of a keyed table under its merge rule."""
    return FOLDS[spec.merge](changelog, spec)


def merge_into(state: DataFrame | None, batch: DataFrame, spec: TableSpec) -> DataFrame:
    """The state after a batch of changes, whatever batches came before; ``live`` reads it."""
    return MERGES[spec.merge](state, batch, spec)


def live(state: DataFrame, spec: TableSpec) -> DataFrame:
    """The rows of a keyed table from its state."""
    if spec.merge == "latest":
        return state.filter(adds()).select(*spec.columns)
    return state.select(*spec.columns) if spec.merge == "partial-update" else read_counted(state, spec)


def fold_latest(changelog: DataFrame, spec: TableSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """Last row wins; a key whose last change is a retraction is gone."""
    columns = [*spec.values, *keep]
    kept = without_retractions(changelog) if spec.ignore_delete else changelog
    rows = kept.withColumn("_at", order_key())
    alive = F.max_by(adds(), F.col("_at")).alias("_alive")
    if all_fixed_width(rows.schema, columns):
        # Fixed-width buffers let Spark aggregate by hash instead of by sorting.
        last = rows.groupBy(*spec.pk).agg(alive, *[F.max_by(c, "_at").alias(c) for c in columns])
        return last.filter("_alive").select(*spec.pk, *columns)
    last = rows.groupBy(*spec.pk).agg(alive, F.max_by(F.struct(*columns), F.col("_at")).alias("_row"))
    return last.filter("_alive").select(*spec.pk, "_row.*")


def fold_images(changelog: DataFrame, pk: list[str], values: list[str], output: str = "new") -> DataFrame:
    """Last row per key as one struct, null for keys whose last change is a retraction, and its position ``at``."""
    image = F.when(adds(), F.struct(*values))
    last = F.max_by(F.struct(image.alias(output)), order_key()).alias("_last")
    return changelog.groupBy(*pk).agg(last, F.max(order_key()).alias("at")).select(*pk, f"_last.{output}", "at")


def merge_latest(state: DataFrame | None, batch: DataFrame, spec: TableSpec) -> DataFrame:
    """The last change of every key with its ``op`` and ``seq``; a removal stays as one."""
    rows = batch.select("op", "seq", *spec.columns)
    if spec.ignore_delete:
        rows = without_retractions(rows)
    if state is not None:
        rows = state.select(*rows.columns).unionByName(rows)
    rest = ["op", "seq", *spec.values]
    if all_fixed_width(rows.schema, [c for c in rest if c != "op"]):
        # Position and kind in one number keep the buffers fixed in width.
        rows = rows.withColumn("_at", order_key())
        aggs = [F.max_by(c, "_at").alias(c) for c in ("seq", *spec.values)]
        last = rows.groupBy(*spec.pk).agg(F.max_by(adds(), F.col("_at")).alias("_alive"), *aggs)
        return last.withColumn("op", F.when(F.col("_alive"), UPDATE_AFTER).otherwise(DELETE)).select(*rows.columns[:-1])
    last = rows.groupBy(*spec.pk).agg(F.max_by(F.struct(*rest), order_key()).alias("_row"))
    return last.select(*spec.pk, "_row.*").select(*rows.columns)


def fold_partial_update(changelog: DataFrame, spec: TableSpec, keep_order: bool = False) -> DataFrame:
    """Per key and column, the last value that is not null.

    Columns in ``spec.null_overwrites`` take nulls too. With ``keep_order`` the
    position of each value is returned as well, so that a later merge places changes
    that arrive out of order correctly.
    """
    if spec.ignore_delete:
        rows = without_retractions(changelog)
    else:
        refused = F.raise_error(F.lit(f"{spec.name}: partial update without ignore_delete got a retraction"))
        rows = changelog.withColumn("op", F.when(adds(), F.col("op")).otherwise(refused.cast("string")))
    at = order_key()
    have = set(rows.columns)
    rows = rows.withColumns(
        {
            ORDER_PREFIX + c: F.coalesce(F.col(ORDER_PREFIX + c), at) if ORDER_PREFIX + c in have else at
            for c in spec.values
        }
    )

    aggs = []
    for c in spec.values:
        pos = ORDER_PREFIX + c
        if c in spec.null_overwrites:
            aggs.append(F.max_by(c, pos).alias(c))
            order = F.max(pos)
        else:
            present = F.col(c).isNotNull()
            aggs.append(F.max_by(F.when(present, F.col(c)), F.when(present, F.col(pos))).alias(c))
            order = F.max(F.when(present, F.col(pos)))
        if keep_order:
            aggs.append(order.alias(pos))
    return rows.groupBy(*spec.pk).agg(*aggs)


def merge_partial_update(state: DataFrame | None, batch: DataFrame, spec: TableSpec) -> DataFrame:
    """The merged values, each with the position it was set at."""
    ordered = [c for c in batch.columns if c.startswith(ORDER_PREFIX)]
    stacked = _stack(state, batch.select("op", "seq", *spec.columns, *ordered))
    return fold_partial_update(stacked, spec, keep_order=True)


def fold_aggregation(changelog: DataFrame, spec: TableSpec) -> DataFrame:
    """Sums, smallest and largest values and averages; retractions take a row back, nulls add nothing.

    ``live_rows`` counts the rows behind a key: a sum of 0 may be real, so keys that
    lost all their rows are told apart by the count, not by the sum. Where there is nothing
    but sums, one aggregation gives them, in a stream too; see ``count_values`` for the rest.
    """
    counted = count_values(changelog, spec)
    return counted if _only_sums(spec) else read_counted(counted, spec)


def count_values(changelog: DataFrame, spec: TableSpec) -> DataFrame:
    """What an aggregated table keeps so that every row can be taken back.

    Sums are signed. Smallest and largest values are a multiset: one row per key and
    combination of values with the count of the rows behind it, which a retraction lowers. It
    combines before the shuffle and is as large as the distinct values. Averages keep a sum
    and a count (``_n_`` and the column) of values that are not null.
    """
    rows = without_retractions(changelog) if spec.ignore_delete else changelog
    weight = F.when(adds(), F.lit(1)).otherwise(F.lit(-1)).cast("bigint")
    aggs = []
    for c, rule in spec.aggregates.items():
        if rule in EXTREMES:
            continue
        value = F.col(c).cast("bigint") if is_integral(rows, c) else F.col(c)
        aggs.append(F.sum(signed(value)).alias(c))
        if rule == "avg":
            held = F.when(F.col(c).isNotNull(), weight)
            if COUNT + c in rows.columns:
                held = F.coalesce(F.col(COUNT + c), held)
            aggs.append(F.sum(held).alias(COUNT + c))
    if LIVE in rows.columns:
        weight = F.coalesce(F.col(LIVE), weight)
    return rows.groupBy(*spec.pk, *_extremes(spec)).agg(*aggs, F.sum(weight).alias(LIVE))


def read_counted(counted: DataFrame, spec: TableSpec) -> DataFrame:
    """The aggregated rows from what ``count_values`` keeps."""
    if _only_sums(spec):
        return counted
    there = F.col(LIVE) > 0

    def merged(c: str, rule: str) -> Column:
        if rule in EXTREMES:
            value = F.when(there, F.col(c))
            return (F.min(value) if rule == "min" else F.max(value)).alias(c)
        if rule == "sum":
            return F.sum(c).alias(c)
        held = F.sum(COUNT + c)
        return (F.sum(c) / F.when(held != 0, held)).alias(c)

    values = [merged(c, rule) for c, rule in spec.aggregates.items()]
    return counted.groupBy(*spec.pk).agg(*values, F.sum(LIVE).alias(LIVE))


def merge_aggregation(state: DataFrame | None, batch: DataFrame, spec: TableSpec) -> DataFrame:
    counted = [c for c in (LIVE, *(COUNT + c for c in spec.aggregates)) if c in batch.columns]
    rows = batch.select("op", "seq", *spec.pk, *spec.aggregates, *counted)
    return count_values(_stack(state, rows), spec)


def _extremes(spec: TableSpec) -> list[str]:
    return [c for c, rule in spec.aggregates.items() if rule in EXTREMES]


def _only_sums(spec: TableSpec) -> bool:
    return set(spec.aggregates.values()) <= {"sum"}


def without_retractions(changelog: DataFrame) -> DataFrame:
    """The ignore-delete policy: retracting rows have no effect."""
    return changelog.filter(adds())


def _stack(state: DataFrame | None, batch: DataFrame) -> DataFrame:
    if state is None:
        return batch
    # Sums need no position, and partial updates carry one for each value.
    earlier = state.withColumn("op", F.lit(INSERT)).withColumn("seq", F.lit(None).cast("bigint"))
    return earlier.unionByName(batch, allowMissingColumns=True)


FOLDS = {"latest": fold_latest, "partial-update": fold_partial_update, "aggregation": fold_aggregation}
MERGES = {"latest": merge_latest, "partial-update": merge_partial_update, "aggregation": merge_aggregation}
