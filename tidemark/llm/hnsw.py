"""Approximate nearest neighbours: a navigable small-world graph per shard, shard results merged."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.vectors import dealt, each_shard_and_block, matrix, one_per_id, ranked, top, usable
from tidemark.llm.words import mix

#: Links per node (twice as many in the lowest layer) and beam widths while building and searching.
LINKS, BUILD_BEAM, SEARCH_BEAM = 16, 64, 128
#: Vectors per shard, queries per block, nodes inserted and nodes expanded side by side.
SHARD, BLOCK, INSERTED, EXPANDED = 8192, 256, 128, 4
#: Nodes by which a search enters a layer, and links back that a node takes at a time.
ENTRIES, AT_ONCE = 16, 16
#: One in so many nodes, the most isolated ones, has a graph of its own too.
ISOLATED = 4


class Graph:
    """A hierarchical navigable small-world graph over unit vectors.

    ``layers[l]`` holds the neighbours of all nodes in layer ``l`` as one flat array of node
    numbers, a row of fixed width per node, -1 where a row is not full. Nodes reach up to a
    random layer, each with 1/LINKS of the nodes below it.
    """

    def __init__(self, units: np.ndarray, links: int = LINKS, beam: int = BUILD_BEAM):
        self.units = np.ascontiguousarray(units, np.float32)
        self.links = links
        n = len(units)
        draw = (mix(np.arange(1, n + 1, dtype=np.uint64)) >> np.uint64(11)).astype(np.float64) / (1 << 53)
        self.height = np.minimum((-np.log(np.maximum(draw, 1e-300)) / np.log(links)).astype(np.int64), 12)
        if n:
            self.height[0] = self.height.max()
        top_layer = int(self.height.max(initial=0))
        widths = [2 * links] + [links] * top_layer
        self.layers = [np.full((n, w), -1, np.int32) for w in widths]
        self.nearness = [np.full((n, w), -np.inf, np.float32) for w in widths]
        done = min(n, 1)
        while done < n:
            stop = min(n, done + min(done, INSERTED))
            self._insert(np.arange(done, stop), beam)
            done = stop
        self._reach_all()

    @classmethod
    def stored(cls, units: np.ndarray, widths: list[int], data: bytes) -> Graph:
        """A graph from its flat arrays, for searching."""
        graph = cls.__new__(cls)
        graph.units = np.ascontiguousarray(units, np.float32)
        flat, graph.layers, at = np.frombuffer(data, np.int32), [], 0
        for width in widths:
            graph.layers.append(flat[at : at + len(units) * width].reshape(-1, width))
            at += len(units) * width
        return graph

    def _insert(self, nodes: np.ndarray, beam: int) -> None:
        """Finds the neighbours of ``nodes`` in the graph so far and among each other, and links them both ways."""
        own = self.units[nodes] @ self.units[nodes].T
        entry = np.zeros((len(nodes), 1), np.int64)
        for layer in range(len(self.layers) - 1, -1, -1):
            here = self.height[nodes] >= layer
            ids, near = self._beam(self.units[nodes], entry, layer, beam if here.any() else 1)
            entry = ids[:, : max(1, beam // 8)] if layer else ids
            back = []
            for i in np.flatnonzero(here):
                earlier = np.flatnonzero(here[:i])
                candidates = np.concatenate((ids[i][ids[i] >= 0], nodes[earlier]))
                nearness = np.concatenate((near[i][ids[i] >= 0], own[i, earlier]))
                order = np.argsort(-nearness, kind="stable")[:beam]
                chosen = self._link(int(nodes[i]), layer, candidates[order], nearness[order])
                back.append((candidates[order][chosen], np.full(len(chosen), nodes[i]), nearness[order][chosen]))
            if back:
                self._link_back(layer, *(np.concatenate(x) for x in zip(*back)))

    def _link(self, node: int, layer: int, candidates: np.ndarray, nearness: np.ndarray) -> list[int]:
        """Links ``node`` to near candidates that are nearer to it than to those already chosen, then fills up."""
        between = self.units[candidates] @ self.units[candidates].T
        ok, chosen, rest = np.ones(len(candidates), bool), [], []
        for c in range(len(candidates)):
            if len(chosen) == self.links:
                break
            if ok[c]:
                chosen.append(c)
                ok &= between[c] < nearness
            else:
                rest.append(c)
        chosen += rest[: self.links - len(chosen)]
        self.layers[layer][node, : len(chosen)] = candidates[chosen]
        self.nearness[layer][node, : len(chosen)] = nearness[chosen]
        return chosen

    def _link_back(self, layer: int, targets: np.ndarray, sources: np.ndarray, nearness: np.ndarray) -> None:
        """Links ``targets`` back to ``sources``. A full row is chosen anew by the rule of ``_link``, which keeps its long links."""
        neighbours, near = self.layers[layer], self.nearness[layer]
        while len(targets):
            order = np.argsort(targets, kind="stable")
            targets, sources, nearness = targets[order], sources[order], nearness[order]
            first = np.flatnonzero(np.concatenate(([True], targets[1:] != targets[:-1])))
            turn = np.arange(len(targets)) - np.repeat(first, np.diff(np.append(first, len(targets))))
            now = turn < AT_ONCE
            rows = targets[first]
            more = np.full((len(rows), AT_ONCE), -1, np.int32)
            more_near = np.full(more.shape, -np.inf, np.float32)
            place = np.cumsum(turn == 0)[now] - 1
            more[place, turn[now]], more_near[place, turn[now]] = sources[now], nearness[now]
            ids = np.concatenate((neighbours[rows], more), 1)
            values = np.concatenate((near[rows], more_near), 1)
            for part in range(0, len(rows), 1024):
                here = slice(part, part + 1024)
                neighbours[rows[here]], near[rows[here]] = self._chosen(ids[here], values[here], neighbours.shape[1])
            targets, sources, nearness = targets[~now], sources[~now], nearness[~now]

    def _chosen(self, ids: np.ndarray, near: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` links to keep of each row: first those nearer to the node than to a better link, then the nearest."""
        order = np.argsort(-near, axis=1, kind="stable")
        ids, near = np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
        full = np.flatnonzero(ids[:, width] >= 0)
        if len(full):
            vectors = self.units[ids[full]]
            between = np.matmul(vectors, vectors.transpose(0, 2, 1))
            some = near[full]
            ok = ids[full] >= 0
            for c in range(ids.shape[1]):
                # A candidate that is left covers those behind it which are nearer to it than to the node.
                ok[:, c + 1 :] &= ~(ok[:, c, None] & (between[:, c, c + 1 :] >= some[:, c + 1 :]))
            better = np.argsort(~ok, axis=1, kind="stable")
            ids[full] = np.take_along_axis(ids[full], better, 1)
            near[full] = np.take_along_axis(some, better, 1)
        return ids[:, :width], near[:, :width]

    def _reach_all(self) -> None:
        """Gives nodes that no path in the lowest layer leads to a link from the nearest node that has one."""
        n = len(self.units)
        while n:
            reached = np.zeros(n, bool)
            edge = np.zeros(1, np.int64)
            reached[0] = True
            while len(edge):
                found = np.unique(self.layers[0][edge])
                edge = found[(found >= 0) & ~reached[found]]
                reached[edge] = True
            lost = np.flatnonzero(~reached)
            if not len(lost):
                return
            known = np.flatnonzero(reached)
            near = np.empty(len(lost), np.int64)
            for part in range(0, len(lost), 512):
                near[part : part + 512] = known[(self.units[lost[part : part + 512]] @ self.units[known].T).argmax(1)]
            # One new link a node and round; where one lost node of a cluster is reached, others mostly are too.
            hosts, which = np.unique(near, return_index=True)
            extra = np.full((n, 1), -1, np.int32)
            extra[hosts, 0] = lost[which]
            self.layers[0] = np.concatenate((self.layers[0], extra), 1)

    def _beam(self, queries: np.ndarray, entry: np.ndarray, layer: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` best nodes found for each query from its entries, best first; -1 where there are fewer."""
        rows = np.arange(len(queries))[:, None]
        seen = np.zeros((len(queries), len(self.units) + 1), bool)
        seen[:, -1] = True  # where -1 points
        ids = entry
        near = np.where(ids >= 0, np.einsum("qnd,qd->qn", self.units[ids], queries), -np.inf)
        seen[rows, ids] = True
        spread = np.zeros(ids.shape, bool) | (ids < 0)
        while True:
            waiting = np.where(spread, -np.inf, near)
            best = np.argsort(-waiting, axis=1, kind="stable")[:, :EXPANDED]
            some = np.take_along_axis(waiting, best, 1) > -np.inf
            if not some.any():
                order = np.argsort(-near, axis=1, kind="stable")
                return np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
            np.put_along_axis(spread, best, True, 1)
            taken = np.where(some, np.take_along_axis(ids, best, 1), -1)
            fresh = np.where(taken[:, :, None] >= 0, self.layers[layer][taken], -1).reshape(len(queries), -1)
            fresh.sort(axis=1)
            fresh[:, 1:][fresh[:, 1:] == fresh[:, :-1]] = -1
            fresh[seen[rows, fresh]] = -1
            seen[rows, fresh] = True
            scores = np.where(fresh >= 0, np.einsum("qnd,qd->qn", self.units[fresh], queries), -np.inf)
            ids = np.concatenate((ids, fresh), 1)
            near = np.concatenate((near, scores), 1)
            spread = np.concatenate((spread, fresh < 0), 1)
            if ids.shape[1] > width:
                keep = np.argpartition(-near, width - 1, axis=1)[:, :width]
                ids, near, spread = (np.take_along_axis(x, keep, 1) for x in (ids, near, spread))

    def isolated(self) -> np.ndarray:
        """The nodes whose fourth nearest link is farthest, one in ``ISOLATED`` of all.

        In crowded data a search fills its beam with a cluster and never comes by the few
        nodes outside; among themselves these are found.
        """
        fourth = np.sort(self.nearness[0], axis=1)[:, -4]
        return np.sort(np.argsort(fourth, kind="stable")[: -(-len(self.units) // ISOLATED)])

    def search(self, queries: np.ndarray, beam: int = SEARCH_BEAM) -> np.ndarray:
        """About the ``beam`` nearest nodes of each unit query, nearest first; -1 where there are fewer."""
        queries = np.ascontiguousarray(queries, np.float32)
        entry = np.zeros((len(queries), 1), np.int64)
        for layer in range(len(self.layers) - 1, 0, -1):
            entry = self._beam(queries, entry, layer, ENTRIES)[0]
        return self._beam(queries, entry, 0, beam)[0]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; safe for very large and very small numbers."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def nearest_by_cosine(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    beam: int = SEARCH_BEAM,
) -> DataFrame:
    """For every query its ``k`` nearest vectors by cosine, approximately, never itself.

    Columns ``query_id``, ``rank`` from 1, ``vec_id``, ``score``: the cosine in double
    precision of the vectors as given; ties go to the smaller id. Vectors that are null,
    empty, zero or hold null or non-finite numbers take no part, nor do null ids; lengths
    are compared only with the same length. Repeated rows are found as often as they occur;
    a query id is asked once, with its smallest vector. Other columns are ignored. Without
    queries or vectors there are no rows.

    All vectors are indexed: dealt into shards of about ``SHARD``, equal vectors of a
    shard as one node, so copies do not crowd the graph. Full rows of links are pruned by the
    rule that chose them, every node is made reachable, and the most isolated nodes of a
    shard have a second graph. Every shard is searched by every block of queries, and the
    shards' best are merged.
    """
    some = F.exists("vector", lambda x: x != 0)
    rows = usable(vectors, id_col, vector_col).where(some)
    asked = one_per_id(usable(queries, id_col, vector_col).where(some))
    rows, shards = dealt(rows, "shard", SHARD, rows.count())
    asked, blocks = dealt(asked, "block", BLOCK, asked.count())
    index = rows.groupBy("dims", "shard").applyInArrow(
        _build,
        "dims int, shard int, ids binary, vectors binary, nodes binary, widths array<int>, graph binary, "
        "isolated binary, isolated_widths array<int>, isolated_graph binary",
    )
    schema = "query_id long, vec_id long, score double"
    return ranked(each_shard_and_block(index, shards, asked, blocks, _search(k, beam), schema), k)


def _build(key: tuple, table: pa.Table) -> pa.Table:
    """One row: ids and vectors of a shard, the node of each row, and the graph's layers end to end."""
    vectors, ids = matrix(table.column("vector")), table.column("id").to_numpy()
    order = np.argsort(ids, kind="stable")
    vectors, ids = vectors[order], ids[order]
    content = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.shape[1] * 8))).ravel()
    _, first, node = np.unique(content, return_index=True, return_inverse=True)
    units = unit(vectors[first])
    graph = Graph(units)
    isolated = graph.isolated()
    second = Graph(units[isolated])
    return pa.table(
        {
            "dims": pa.array([key[0].as_py()], pa.int32()),
            "shard": pa.array([key[1].as_py()], pa.int32()),
            "ids": pa.array([ids.tobytes()], pa.binary()),
            "vectors": pa.array([vectors.tobytes()], pa.binary()),
            "nodes": pa.array([node.astype(np.int32).tobytes()], pa.binary()),
            "widths": pa.array([[x.shape[1] for x in graph.layers]], pa.list_(pa.int32())),
            "graph": pa.array([b"".join(x.tobytes() for x in graph.layers)], pa.binary()),
            "isolated": pa.array([isolated.tobytes()], pa.binary()),
            "isolated_widths": pa.array([[x.shape[1] for x in second.layers]], pa.list_(pa.int32())),
            "isolated_graph": pa.array([b"".join(x.tobytes() for x in second.layers)], pa.binary()),
        }
    )


def _search(k: int, beam: int):
    def run(shard: pa.Table, block: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if shard.num_rows and block.num_rows:
            row = shard.to_pylist()[0]
            ids = np.frombuffer(row["ids"], np.int64)
            vectors = np.frombuffer(row["vectors"]).reshape(len(ids), -1)
            node = np.frombuffer(row["nodes"], np.int32)
            members = np.argsort(node, kind="stable")  # smaller ids first within a node
            starts = np.searchsorted(node[members], np.arange(node.max() + 2))
            points = unit(vectors[members[starts[:-1]]])
            graph = Graph.stored(points, row["widths"], row["graph"])
            isolated = np.frombuffer(row["isolated"], np.int64)
            second = Graph.stored(points[isolated], row["isolated_widths"], row["isolated_graph"])
            asked = matrix(block.column("vector"))
            alone = second.search(unit(asked), beam)
            found = np.concatenate((graph.search(unit(asked), beam), np.append(isolated, -1)[alone]), 1)
            units = unit(vectors)
            for query_id, query, nodes in zip(block.column("id").to_pylist(), unit(asked), found):
                # No more than k + 1 members of a node can be in the answer, the smallest.
                nodes = np.unique(nodes[nodes >= 0])
                some = [members[starts[x] : min(starts[x + 1], starts[x] + k + 1)] for x in nodes]
                some = np.concatenate(some)
                some = some[ids[some] != query_id]
                scores = (units[some] * query).sum(axis=1)  # equal vectors get equal scores
                best = top(ids[some], scores, k)
                out += zip([query_id] * len(best), ids[some][best].tolist(), scores[best].tolist())
        columns = list(zip(*out)) or [[], [], []]
        kinds = (("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()))
        return pa.table({n: pa.array(c, t) for (n, t), c in zip(kinds, columns)})

    return run
