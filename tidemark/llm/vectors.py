"""What the two vector searches share: usable vectors, shards, query blocks, merging."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, vector, dims)`` of the rows whose vector is neither null nor empty nor holds a null or non-finite number."""
    v = F.col(vector_col).cast("array<double>")
    return (
        vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("vector"))
        .where(F.col("vector").isNotNull() & F.col("id").isNotNull())
        .where(F.size("vector") > 0)
        .where(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
        .withColumn("dims", F.size("vector"))
    )


def one_per_id(rows: DataFrame) -> DataFrame:
    """One usable vector per id, the smallest: a query is asked once."""
    return rows.groupBy("id").agg(F.min("vector").alias("vector")).withColumn("dims", F.size("vector"))


def dealt(rows: DataFrame, name: str, per_part: int, count: int) -> tuple[DataFrame, int]:
    """``rows`` with a part number in column ``name``: as many parts as hold ``per_part`` of ``count`` rows each."""
    parts = max(1, -(-count // per_part))
    return rows.withColumn(name, F.pmod(F.xxhash64("id", "vector"), F.lit(parts)).cast("int")), parts


def matrix(column: pa.ChunkedArray, kind: type = np.float64) -> np.ndarray:
    """Vectors of one length as the rows of a matrix."""
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(kind, copy=False).reshape(len(column), -1)


def each_shard_and_block(
    index: DataFrame, shards: int, queries: DataFrame, blocks: int, search: Callable, schema: str
) -> DataFrame:
    """Runs ``search(shard rows, query rows)`` for every shard and block of queries of one vector length.

    Shards are copied once per block and queries once per shard; a task holds one of each.
    """
    keys = ["dims", "shard", "block"]
    index = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    queries = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    return index.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(search, schema)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each query: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``; ties to the smaller id."""
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def top(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, ties to smaller ids, best first."""
    if len(ids) > 4 * k:
        bound = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= bound)
    else:
        some = np.arange(len(ids))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]
