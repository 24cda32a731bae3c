"""Stateful streaming operators: lookups that wait for a timer, and merged rows with their old images.

The lookup is a function for ``applyInPandasWithState``. Its rows travel as JSON objects, so that
whole numbers and times keep their exact values and nulls stay nulls whatever the columns;
numbers with a fraction travel as doubles. The function holds no reference to this package:
Spark carries it to the workers whole. The merge is a streaming aggregation without Python rows.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructField, StructType

from tidemark.functions.rowkind import UPDATE_BEFORE, adds
from tidemark.functions.temporal import micros
from tidemark.sources.envelope import TIMESTAMP_TEXT
from tidemark.specs import TableSpec, table_schema

#: How times are written in JSON, to the microsecond.
_TIMES = {"timestampFormat": TIMESTAMP_TEXT, "timestampNTZFormat": TIMESTAMP_TEXT.removesuffix("XXX")}


def as_json(columns: list[str] | tuple[str, ...]) -> Column:
    return F.to_json(F.struct(*columns), _TIMES)


def from_json(column: str, schema: StructType) -> Column:
    return F.from_json(column, schema, _TIMES)


def lookup_when_due(
    facts: DataFrame,
    versions: DataFrame,
    ticks: DataFrame,
    on: str,
    spread_by: str,
    values: tuple[str, ...],
    *,
    delay: int,
    retries: int,
    cells: int,
) -> DataFrame:
    """A streamed lookup with retry: ``seq`` and ``row``, the fact and the values it found, as JSON.

    ``facts`` and ``versions`` are streams of changelog rows, ``ticks`` a stream of ``clock``, the time by
    which all changes before it have come. A fact waits in the state of its key until an
    attempt finds a live version of its own instant or the last attempt is over; an
    event-time timer wakes it at each attempt. Facts behind the clock are never dropped:
    only ticks move the watermark.

    A key's facts are dealt over ``cells`` by ``spread_by``, and its versions go to all of
    them, so that a key with a large share of the facts is not one state.
    """
    none = F.lit(None)
    numbers = F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))
    # Never null, as in the other rows: a state's key keeps its type when a batch brings ticks only.
    cell = F.coalesce(F.pmod(F.xxhash64(spread_by), F.lit(cells)).cast("int"), F.lit(0))
    asked = facts.select(
        on, cell.alias("cell"), F.lit("fact").alias("kind"),
        micros("commit_ts").alias("at"), "seq", as_json(facts.drop("op", "commit_ts", "seq").columns).alias("row"),
        adds().alias("alive"), none.cast("timestamp").alias("clock"),
    )
    known = versions.filter((F.col("op") != UPDATE_BEFORE) & F.col(on).isNotNull()).select(
        on, numbers.alias("cell"), F.lit("version").alias("kind"), micros("commit_ts").alias("at"), "seq",
        as_json(values).alias("row"), adds().alias("alive"), none.cast("timestamp").alias("clock"),
    )
    zero = F.lit(0).cast("bigint")
    moved = ticks.select(
        none.cast(facts.schema[on].dataType).alias(on), F.lit(0).alias("cell"), F.lit("tick").alias("kind"),
        zero.alias("at"), zero.alias("seq"), none.cast("string").alias("row"), F.lit(False).alias("alive"), "clock",
    )
    rows = asked.unionByName(known).unionByName(moved).withWatermark("clock", "0 seconds")
    return rows.groupBy(on, "cell").applyInPandasWithState(
        _waiting_lookup(delay, retries), "seq bigint, row string", "held string", "append",
        GroupStateTimeout.EventTimeTimeout,
    )


def _waiting_lookup(delay: int, retries: int) -> Callable:
    def look_up(key: tuple, batches: Iterator, state: GroupState) -> Iterator:
        import json
        from bisect import bisect_right

        import pandas as pd

        versions, waiting = json.loads(state.get[0]) if state.exists else ([], [])
        if not state.hasTimedOut:
            for batch in batches:
                for kind, at, seq, row, alive in zip(*(batch[c].tolist() for c in ("kind", "at", "seq", "row", "alive"))):
                    if kind == "version":
                        versions.append([at, seq, alive, row])
                    elif kind == "fact":
                        waiting.append([at, seq, row])
        versions.sort(key=lambda v: v[:2])
        times = [v[0] for v in versions]
        now = state.getCurrentWatermarkMs() * 1000
        done, still, due = [], [], None
        for at, seq, row in waiting:
            found = None
            for attempt in range(retries + 1):
                then = at + attempt * delay
                if attempt and then > now:
                    due = then if due is None else min(due, then)
                    still.append([at, seq, row])
                    break
                last = bisect_right(times, then) - 1
                if last >= 0 and versions[last][2]:
                    found = versions[last][3]
                    break
            else:
                found = "{}"
            if found is None:
                continue
            done.append((seq, json.dumps({**json.loads(row), **json.loads(found)})))
        # A tick has a group of its own, which needs no state.
        if versions or still:
            state.update((json.dumps([versions, still]),))
            if due is not None:
                # Spark wakes a state whose time lies before the watermark.
                state.setTimeoutTimestamp(max(-(-due // 1000) - 1, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(done, columns=["seq", "row"])

    return look_up


def meetings(facts: DataFrame, dims: DataFrame, on: str, pk: str, value: str) -> DataFrame:
    """Every meeting of a fact version with a version of its dimension row, as either of them comes.

    A stream-stream join, whose state holds each version as an entry of its own, however
    many facts share a dimension row: ``pk``, ``seq`` of the fact, ``met`` (that of the
    dimension row) and ``value``, null for the removal of the dimension row.
    """
    left = facts.filter(adds() & F.col(on).isNotNull()).select(pk, on, "seq")
    right = dims.filter((F.col("op") != UPDATE_BEFORE) & F.col(on).isNotNull()).select(
        F.col(on).alias("_on"), F.col("seq").alias("met"), F.when(adds(), F.col(value)).alias(value)
    )
    return left.join(right, F.col(on) == F.col("_on")).select(pk, "seq", "met", value)


def change_schema(spec: TableSpec) -> StructType:
    """The columns of ``halves_and_meetings``."""
    (pk,) = spec.pk
    placed = table_schema("kind string, seq bigint, met bigint, value string").fields
    return StructType([spec.schema[pk], *placed, StructField("image", images_of(spec))])


def images_of(spec: TableSpec) -> StructType:
    (pk,) = spec.pk
    return StructType([f for f in spec.schema.fields if f.name != pk])


def halves_and_meetings(
    found: DataFrame, facts: DataFrame, met: DataFrame, spec: TableSpec, value: str
) -> DataFrame:
    """All that ``merged_pairs`` places, as one stream by key: what a lookup ``found`` (``seq``, and ``row`` as JSON), each fact version, and what it ``met``."""
    (pk,) = spec.pk
    kinds = {f.name: f.dataType for f in change_schema(spec).fields}

    def rows(df: DataFrame, kind: str, key: Column, **given: Column) -> DataFrame:
        given = {"kind": F.lit(kind), "seq": F.col("seq"), **given}
        empty = {c: F.lit(None).cast(kinds[c]) for c in ("met", "value", "image") if c not in given}
        return df.select(key.alias(pk), *[(given | empty)[c].alias(c) for c in kinds if c != pk])

    read = found.withColumn("_row", from_json("row", spec.schema))
    image = F.struct(*[F.col(f"_row.{f.name}").alias(f.name) for f in images_of(spec).fields])
    return (
        rows(read, "half", F.col(f"_row.{pk}"), image=image)
        .unionByName(rows(facts.filter(F.col("op") != UPDATE_BEFORE), "fact", F.col(pk)))
        .unionByName(rows(met, "met", F.col(pk), met=F.col("met"), value=F.col(value).cast("string")))
    )


def merged_pairs(changes: DataFrame, spec: TableSpec, value: str, batch: str) -> DataFrame:
    """The partially updated table as the ``old`` and ``new`` image of every key a batch changes.

    ``changes`` (see ``halves_and_meetings``) carry in ``batch`` the number of the batch that brought
    them; a batch comes whole. Halves set columns that are not null. Meetings set ``value``:
    that of the last version alive while the last fact version it met was, where facts tell
    from when to when each fact version is. Changes are placed by log position, in whatever
    order they come; a key that stays as it was gives no row.

    A streaming aggregation in update mode: a key's state is the list of its changes, and its
    old image is that of the changes before its newest batch.
    """
    (pk,) = spec.pk
    half = F.col("kind") == "half"
    kept = changes.groupBy(pk).agg(
        F.max(batch).alias("_newest"),
        F.collect_list(F.when(half, F.struct(F.col(batch).alias("batch"), "seq", "image"))).alias("_halves"),
        F.collect_list(F.when(~half, F.struct("seq", "met", "value", F.col(batch).alias("batch")))).alias("_lives"),
    )
    # The latest first; a fact follows its meetings, since nulls come last.
    kept = kept.withColumn("_lives", F.sort_array("_lives", asc=False))

    def image(halves: Column, lives: Column) -> Column:
        values = []
        for field in images_of(spec).fields:
            here = F.filter(halves, lambda h: h.image[field.name].isNotNull())
            last = F.array_max(F.transform(here, lambda h: F.struct(h.seq, h.image[field.name].alias("held")))).held
            if field.name == value:
                last = F.coalesce(_last_met(lives).cast(field.dataType), last)
            values.append(last.cast(field.dataType).alias(field.name))
        row = F.struct(*values)
        return F.when(functools.reduce(operator.or_, [v.isNotNull() for v in values]), row)

    def before(changes: Column) -> Column:
        return F.filter(changes, lambda c: c.batch < F.col("_newest"))

    pairs = kept.select(
        pk,
        image(before(F.col("_halves")), before(F.col("_lives"))).alias("old"),
        image(F.col("_halves"), F.col("_lives")).alias("new"),
    )
    return pairs.filter(~F.col("old").eqNullSafe(F.col("new")))


def _last_met(lives: Column) -> Column:
    """The value of the last meeting that overlaps its fact version; ``lives`` come latest first, facts without ``met``.

    One walk: a fact version ends where the later one begins, and a dimension version where the
    later one it met begins.
    """
    start = F.struct(
        *[F.lit(None).cast("bigint").alias(c) for c in ("fact", "end", "until")], F.lit(None).cast("string").alias("found")
    )

    def step(held: Column, life: Column) -> Column:
        other = ~held.fact.eqNullSafe(life.seq)
        end = F.when(other, held.fact).otherwise(held.end)
        until = F.when(~other, held.until)
        since = F.greatest(life.seq, life.met)
        overlaps = life.value.isNotNull() & (end.isNull() | (since < end)) & (until.isNull() | (since < until))
        return F.struct(
            life.seq.alias("fact"),
            end.alias("end"),
            F.coalesce(life.met, until).alias("until"),
            F.when(held.found.isNull() & overlaps, life.value).otherwise(held.found).alias("found"),
        )

    return F.aggregate(lives, start, step, lambda held: held.found)
