"""Ordered walks over keys that may hold a large share of all rows.

A key is *heavy* when it holds more than one part in ``parts`` of the rows, where
``parts`` is the session's number of shuffle partitions: spread evenly, such a key
alone would overfill a task. There are at most ``parts`` heavy keys whatever the
size of the data. Light keys take the plain plan. Equi-joins need none of this: adaptive
execution broadcasts small sides and splits skewed partitions by what the shuffle measured.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 * 1024 * 1024
MIN_HEAVY_ROWS = 100_000
MIN_HEAVY_ROWS_CONF = "tidemark.heavy.minRows"
MARK_GROUPS = 32


def fair_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


@dataclass(frozen=True)
class Cells:
    """Consecutive stretches of an order column holding about equally many rows.

    A value so frequent that it fills several stretches gets ``spread`` extra cells
    after the one of its writers; rows that only read are dealt over them.
    """

    splits: list[float]
    base: list[int]
    spread: list[int]
    count: int

    @classmethod
    def between(cls, marks: Sequence[int]) -> Cells:
        """Cells cut at ``marks``, the even quantiles of the order column."""
        splits, spread = [-math.inf], [0]
        for value, times in sorted(Counter(marks).items()):
            low = float(value)
            if low > splits[-1]:
                splits.append(low)
                spread.append(times if times > 1 else 0)
            if times > 1:
                splits.append(math.nextafter(low, math.inf))
                spread.append(0)
        splits.append(math.inf)
        base, total = [], 0
        for width in spread:
            base.append(total)
            total += 1 + width
        return cls(splits, base, spread, total)

    def most_within(self, distance: float) -> int:
        """The most cells from that of ``x - distance`` to that of ``x``, both included."""
        widest, low = 1, 0
        for high in range(len(self.base)):
            while low < high and self.splits[high] - self.splits[low + 1] > distance:
                low += 1
            widest = max(widest, self.base[high] - self.base[low] + 1)
        return widest

    def assign(self, df: DataFrame, order: str, reads: Column, heavy: Column, output: str = "_cell") -> DataFrame:
        """Adds the cell number, or -1 for light keys."""
        data = df.columns
        cut = Bucketizer(splits=self.splits, inputCol="_cell_at", outputCol="_cell_stretch")
        df = cut.transform(df.withColumn("_cell_at", F.col(order).cast("double")))
        stretch = F.col("_cell_stretch").cast("int")
        cell = stretch
        if any(self.spread):
            width = F.lit(self.spread)[stretch]
            turn = F.when(
                reads & (width > 0), 1 + F.pmod(F.xxhash64(*data), width)
            ).otherwise(F.lit(0))
            cell = (F.lit(self.base)[stretch] + turn).cast("int")
        return df.withColumn(output, F.when(heavy, cell).otherwise(F.lit(-1))).drop("_cell_at", "_cell_stretch")


def carry_over(tails: DataFrame, keys: Sequence[str], tail: str, cells: Cells) -> DataFrame:
    """From the last payload of each cell, what enters every later cell up to the next writing one.

    ``tails`` has one row per heavy key and writing cell, so a key gives at most as many
    rows as there are cells.
    """
    along = Window.partitionBy(*keys).orderBy("_cell")
    until = F.coalesce(F.lead("_cell").over(along), F.lit(cells.count - 1))
    return (
        tails.withColumn("_until", until)
        .filter(F.col("_cell") < F.col("_until"))
        .select(*keys, tail, F.explode(F.sequence(F.col("_cell") + 1, F.col("_until"))).alias("_cell"))
    )


@dataclass(frozen=True)
class Profile:
    """What is known of a set of rows, its keys and its order column."""

    rows: int
    heavy: list[int]
    marks: Callable[[], list[int]]

    def cells(self) -> Cells:
        """Even stretches of the order column; measured when asked for."""
        return Cells.between(self.marks())


def profile(
    df: DataFrame,
    keys: Sequence[str],
    order: str | None = None,
    *,
    parts: int | None = None,
) -> Profile:
    """Counts rows by key and finds the heavy keys.

    Counts are combined before the shuffle and no task gathers more than the rows of its
    keys; the driver gets the ``parts`` largest keys. Keys with few rows
    (``tidemark.heavy.minRows``) are never heavy. Keys are known by their hash: two sharing
    one only means that a light key is split too. What is heavy decides how rows are dealt
    over tasks, never which rows come out.
    """
    spark = df.sparkSession
    parts = parts or fair_parts(spark)
    least = int(spark.conf.get(MIN_HEAVY_ROWS_CONF, str(MIN_HEAVY_ROWS)))
    counts = df.select(key_hash(keys).alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    seen = Observation()
    watched = counts.observe(seen, F.sum("_n").alias("_n"))
    largest = watched.filter(F.col("_n") > least).orderBy(F.desc("_n"), "_h").limit(parts).collect()
    total = seen.get.get("_n") or 0
    return Profile(
        rows=total,
        heavy=[r["_h"] for r in largest if r["_n"] > total / parts],
        marks=lambda: even_marks(df, order, parts),
    )


def even_marks(df: DataFrame, order: str, parts: int) -> list[int]:
    """Values that cut ``order`` into ``parts`` about even shares.

    Quantiles are taken in ``MARK_GROUPS`` groups of input partitions side by side, so that
    no task merges the digests of all others, and put together by their weights.
    """
    if parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    marked = df.select(F.pmod(F.spark_partition_id(), F.lit(MARK_GROUPS)).alias("_part"), F.col(order).alias("_at"))
    groups = marked.groupBy("_part").agg(
        F.count("_at").alias("n"), F.percentile_approx("_at", shares, F.lit(max(1_000, 20 * parts))).alias("marks")
    )
    weighted = sorted((mark, g["n"] / parts) for g in groups.collect() for mark in g["marks"] or [])
    whole = sum(weight for _, weight in weighted)
    marks, reached = [], 0.0
    for mark, weight in weighted:
        reached += weight
        while len(marks) < parts - 1 and reached >= whole * (len(marks) + 1) / parts:
            marks.append(mark)
    return marks


def heavy_keys(df: DataFrame, keys: Sequence[str], parts: int | None = None) -> list[int]:
    """Hashes of the heavy keys."""
    return profile(df.select(*keys), keys, parts=parts).heavy


def is_heavy(keys: Sequence[str], heavy: Sequence[int]) -> Column:
    return key_hash(keys).isin(list(heavy)) if heavy else F.lit(False)


def last_before(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    payload: str,
    output: str,
    *,
    ties: Sequence[str] = (),
    heavy: Sequence[int] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """For each row, the last non-null ``payload`` among the earlier rows of its key.

    Rows are ordered by the bigint column ``order``, then by ``ties``. Rows with a
    null payload only read; among equal orders they must come after the writers.

    Heavy keys are cut into cells along ``order``. The last payload of each cell is
    found by a combining aggregation, and enters every later cell up to the next
    writing one as an extra first row, so each cell can be walked on its own.
    """
    keys, ties = list(keys), list(ties)
    found = None
    if heavy is None:
        found = profile(df.select(*keys, order), keys, order, parts=parts)
        heavy = found.heavy
    ordering = [F.col(order).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in ties]]
    frame = (Window.unboundedPreceding, -1)
    if not heavy:
        walk = Window.partitionBy(*keys).orderBy(*ordering).rowsBetween(*frame)
        return df.withColumn(output, F.last(payload, ignorenulls=True).over(walk))

    columns = df.columns
    hot = is_heavy(keys, heavy)
    cells = (found or profile(df.select(*keys, order), keys, order, parts=parts)).cells()
    rows = cells.assign(df, order, F.col(payload).isNull(), hot)
    tails = (
        rows.filter((F.col("_cell") >= 0) & F.col(payload).isNotNull())
        .groupBy(*keys, "_cell")
        .agg(F.max_by(payload, F.struct(order, *ties)).alias(payload))
    )
    carried = carry_over(tails, keys, payload, cells).withColumn("_carried", F.lit(True))
    walk = Window.partitionBy(*keys, "_cell").orderBy(*ordering).rowsBetween(*frame)
    return (
        rows.withColumn("_carried", F.lit(False))
        .unionByName(carried, allowMissingColumns=True)
        .repartition(*keys, "_cell")
        .withColumn(output, F.last(payload, ignorenulls=True).over(walk))
        .filter(~F.col("_carried"))
        .select(*columns, output)
    )
