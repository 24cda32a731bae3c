"""Exact top-k inner products over an impact-ordered index, score at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.vectors import dealt, each_shard_and_block, matrix, one_per_id, ranked, top, usable

#: Quantised impact levels per dimension, vectors per shard, queries per block.
LEVELS, SHARD, BLOCK = 32, 8192, 256
#: Postings are processed in this many steps, with a test of the proof after each.
STEPS = 12


class ImpactIndex:
    """Posting segments of one shard of integer vectors.

    A segment is a dimension and a level of its quantised values: all vectors whose value
    lies in the level's range. Segments of a dimension lie behind each other in ``order``,
    level by level from ``bounds``.
    """

    def __init__(self, vectors: np.ndarray, levels: int = LEVELS):
        self.vectors = vectors
        self.low = vectors.min(axis=0)
        self.span = vectors.max(axis=0) - self.low + 1
        self.width = -(-self.span // levels)
        self.levels = levels
        level = (vectors - self.low) // self.width
        self.order = np.argsort(level, axis=0, kind="stable").T.copy()
        steps = np.arange(levels + 1)
        self.bounds = np.array([np.searchsorted(np.sort(level[:, d]), steps) for d in range(vectors.shape[1])])

    def search(self, query: np.ndarray, k: int, skip: np.ndarray) -> tuple[np.ndarray, int]:
        """Positions that can be among the ``k`` best, and how many postings were read.

        What a dimension adds to a score is shifted to be at least 0, upwards from the
        smallest value for a positive query number and downwards from the largest for a
        negative one. Segments are read by descending impact, the most that they can add.
        Every vector read counts with the least its segment can add. At any time a vector's
        final score exceeds what it has by at most ``slack``: per dimension, the width of a
        read level or the impact of the next unread one. Reading stops once those within
        ``slack`` of the ``k``-th best so far are few; the others are proven to be out.
        ``skip`` marks positions that may not be found.
        """
        n = len(self.vectors)
        weight = np.abs(query)
        steps = np.arange(self.levels)
        up = query[:, None] > 0
        # Least and most that each (dimension, level) can add.
        base = self.width[:, None] * steps
        least = np.where(up, base, np.maximum(self.span[:, None] - base - self.width[:, None], 0))
        most = np.where(up, np.minimum(base + self.width[:, None], self.span[:, None]) - 1, self.span[:, None] - 1 - base)
        least, most = least * weight[:, None], np.maximum(most, 0) * weight[:, None]
        size = np.diff(self.bounds, axis=1)
        use = (size > 0) & (weight[:, None] > 0)
        dims, levels = np.nonzero(use)
        by_impact = np.argsort(-most[dims, levels], kind="stable")
        dims, levels = dims[by_impact], levels[by_impact]
        sizes = size[dims, levels]
        reach = np.cumsum(sizes)
        total = int(reach[-1]) if len(reach) else 0
        have = np.zeros(n)
        blocked = np.where(skip, -np.inf, 0.0)
        unread = np.where(use, most, 0)
        gap = np.zeros(len(query))
        at = 0
        for step in range(1, STEPS + 1):
            stop = int(np.searchsorted(reach, total * step / STEPS, side="left")) + 1 if total else 0
            stop = min(stop, len(dims))
            d, level = dims[at:stop], levels[at:stop]
            if len(d):
                spans = zip(d.tolist(), self.bounds[d, level].tolist(), self.bounds[d, level + 1].tolist())
                ids = np.concatenate([self.order[x, a:b] for x, a, b in spans])
                have += np.bincount(ids, np.repeat(least[d, level].astype(np.float64), sizes[at:stop]), n)
                unread[d, level] = 0
                np.maximum.at(gap, d, (most - least)[d, level].astype(np.float64))
            at = stop
            slack = np.maximum(gap, unread.max(axis=1)).sum()
            seen = have + blocked
            kth = np.partition(seen, n - k)[n - k] if n > k else -np.inf
            possible = np.flatnonzero((seen >= kth - slack) & ~skip)
            if at == len(dims) or len(possible) <= max(8 * k, n >> 2):
                return possible, int(reach[at - 1]) if at else 0
        return possible, total


def top_inner_products(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256
) -> DataFrame:
    """For every query its ``k`` highest integer inner products among ``vectors``, never itself.

    Components become ``floor(scale * x)``. Columns ``query_id``, ``rank`` from 1,
    ``vec_id``, ``score``; ties go to the smaller id. Vectors that are null, empty or hold
    null or non-finite numbers take no part, nor do null ids; lengths are compared only
    with the same length. Repeated rows are found as often as they occur; a query id is asked
    once, with its smallest vector. Other columns
    are ignored. Products must fit 63 bits. Without queries or vectors there are no rows.

    Vectors are dealt into shards of about ``SHARD``; each is indexed and searched in full
    by blocks of about ``BLOCK`` queries, and the shards' best are merged.
    """
    rows = usable(vectors, id_col, vector_col)
    asked = one_per_id(usable(queries, id_col, vector_col))
    index, shards = dealt(rows, "shard", SHARD, rows.count())
    asked, blocks = dealt(asked, "block", BLOCK, asked.count())
    schema = "query_id long, vec_id long, score long"
    found = each_shard_and_block(index, shards, asked, blocks, _search(k, scale), schema)
    return ranked(found, k)


def _search(k: int, scale: int):
    def run(shard: pa.Table, block: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if shard.num_rows and block.num_rows:
            ids = shard.column("id").to_numpy()
            index = ImpactIndex(np.floor(scale * matrix(shard.column("vector"))).astype(np.int64))
            asked = np.floor(scale * matrix(block.column("vector"))).astype(np.int64)
            for query_id, query in zip(block.column("id").to_pylist(), asked):
                possible, _ = index.search(query, k, ids == query_id)
                scores = index.vectors[possible] @ query
                best = top(ids[possible], scores, k)
                out += zip([query_id] * len(best), ids[possible][best].tolist(), scores[best].tolist())
        columns = list(zip(*out)) or [[], [], []]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns)})

    return run
