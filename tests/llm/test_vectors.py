"""Exact and approximate vector search against brute force."""

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import hnsw, impact
from tidemark.llm.hnsw import Graph, nearest_by_cosine, unit
from tidemark.llm.impact import ImpactIndex, top_inner_products
from tidemark.llm.ship import ship
from tidemark.llm.vectors import top


def rows_with_oddities(n=400, dims=12, seed=2):
    draw = np.random.default_rng(seed)
    rows = [(i * 3, [float(np.float32(x)) for x in v]) for i, v in enumerate(draw.normal(0, 0.4, (n, dims)))]
    same = rows[0][1]
    rows += [(2000 + i, same) for i in range(30)]  # ties
    rows += [rows[5], (5000, None), (5001, []), (5002, [None] + same[1:]), (5003, [float("nan")] + same[1:]),
             (5004, [float("inf")] + same[1:]), (5005, [0.0] * dims), (None, same), (5006, same[:5]), (5007, rows[3][1][:5])]
    return rows


def usable(rows, zero):
    keep = [
        (i, np.array(v, float))
        for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and (zero or any(v))
    ]
    return keep


def test_top_breaks_ties_by_id():
    assert top(np.array([9, 3, 5, 1]), np.array([2, 7, 7, 1]), 3).tolist() == [1, 2, 0]


@pytest.mark.parametrize("levels", [2, 8, 32])
def test_index_never_loses_a_member(levels):
    draw = np.random.default_rng(levels)
    vectors = draw.integers(-50, 90, (700, 9))
    vectors[:, 4] = 3
    index = ImpactIndex(vectors, levels)
    for at in range(0, 700, 35):
        for query in (vectors[at], -vectors[at], np.zeros(9, np.int64)):
            skip = np.arange(700) == at
            possible, read = index.search(query, 5, skip)
            scores = vectors @ query
            scores[at] = -(10**9)
            best = top(np.arange(700), scores, 5)
            inside = scores[possible]
            assert possible[top(possible, inside, 5)].tolist() == best.tolist()
            assert at not in possible and read <= vectors.size


def test_index_stops_before_the_end_when_it_can():
    draw = np.random.default_rng(0)
    vectors = draw.integers(0, 20, (2000, 6))
    vectors[:8] = 400
    index = ImpactIndex(vectors, 16)
    possible, read = index.search(np.full(6, 10), 5, np.zeros(2000, bool))
    assert len(possible) < 500 and read < vectors.size


def test_exact_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(impact, "SHARD", 90)
    monkeypatch.setattr(impact, "BLOCK", 40)
    rows = rows_with_oddities()
    df = ship(spark).createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, shard int, dims int")
    got = top_inner_products(df, df.where("vec_id % 5 = 0"), k=4)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    have = {}
    for r in got.collect():
        have.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    good = [(i, np.floor(256 * v).astype(int)) for i, v in usable(rows, True)]
    want = {}
    for q, x in good:
        if q % 5 == 0:
            scores = sorted((-int(x @ y), i) for i, y in good if i != q and len(x) == len(y))[:4]
            want.setdefault(q, [(k + 1, i, -s) for k, (s, i) in enumerate(scores)])
    assert {k: sorted(v)[: len(want[k])] for k, v in have.items()} == {k: v for k, v in want.items() if v}


def test_no_vectors_no_queries(spark):
    df = ship(spark).createDataFrame([], "vec_id long, embedding array<float>")
    one = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>")
    for search in (top_inner_products, nearest_by_cosine):
        assert search(df, df).count() == search(one, df).count() == search(one, one).count() == 0


def test_graph_recall_and_stored_form():
    draw = np.random.default_rng(5)
    units = unit(draw.normal(0, 1, (1500, 24)))
    graph = Graph(units)
    stored = Graph.stored(units, [x.shape[1] for x in graph.layers], b"".join(x.tobytes() for x in graph.layers))
    queries = unit(draw.normal(0, 1, (60, 24)))
    found = stored.search(queries)
    assert (found == graph.search(queries)).all()
    nearest = np.argsort(-(queries @ units.T), axis=1)[:, :5]
    assert np.mean([len(set(a) & set(b)) / 5 for a, b in zip(found.tolist(), nearest.tolist())]) >= 0.9
    assert [len(set(row[row >= 0])) for row in found] == [(row >= 0).sum() for row in found]


@pytest.mark.parametrize("spread, clusters, alone", [(0.001, 20, 200), (0.01, 20, 200), (0.1, 20, 200), (0.1, 4, 800), (0.3, 40, 100)])
def test_recall_among_clusters_and_outliers(spread, clusters, alone):
    """The stored index as a query reads it: nine of ten neighbours, of outliers too, and none without any."""
    draw = np.random.default_rng(7)
    centres = draw.normal(size=(clusters, 64))
    rows = [centres[i % clusters] + spread * draw.normal(size=64) for i in range(4000 - alone)]
    rows = draw.permutation(np.array(rows + list(draw.normal(size=(alone, 64)))))
    outlier = np.sort(unit(rows) @ unit(rows).T, 1)[:, -6] < 0.7
    table = pa.table({"id": pa.array(np.arange(4000)), "vector": pa.array(list(rows), pa.list_(pa.float64()))})
    index = hnsw._build((pa.scalar(64), pa.scalar(0)), table)
    for asked in (np.flatnonzero(outlier), np.arange(0, 4000, 50)):
        got = hnsw._search(5, hnsw.SEARCH_BEAM)(index, table.take(pa.array(asked)))
        found = {}
        for query, other in zip(got.column("query_id").to_pylist(), got.column("vec_id").to_pylist()):
            found.setdefault(query, set()).add(other)
        exact = unit(rows)[asked] @ unit(rows).T
        exact[np.arange(len(asked)), asked] = -2
        shares = [len(found[q] & set(np.argsort(-exact[n], kind="stable")[:5].tolist())) / 5 for n, q in enumerate(asked.tolist())]
        assert np.mean(shares) >= 0.9


def test_every_node_is_reached():
    draw = np.random.default_rng(3)
    rows = np.concatenate([draw.normal(size=(1, 16)) + 0.0001 * draw.normal(size=(300, 16)) for _ in range(6)])
    graph = Graph(unit(rows))
    reached, edge = {0}, [0]
    while edge:
        edge = [int(x) for x in np.unique(graph.layers[0][edge]) if x >= 0 and int(x) not in reached]
        reached.update(edge)
    assert len(reached) == len(rows)


def test_graphs_of_few_nodes():
    for n in (1, 2, 3):
        found = Graph(np.eye(3)[:n]).search(np.eye(3))
        assert [sorted(x[x >= 0].tolist()) for x in found] == [list(range(n))] * 3


def test_nearest_by_cosine(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD", 150)
    monkeypatch.setattr(hnsw, "BLOCK", 50)
    rows = rows_with_oddities()
    rows += [(6000 + i, [1e200 * x for x in v]) for i, (_, v) in enumerate(rows[:3])]
    df = ship(spark).createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, graph string")
    have = {}
    for r in nearest_by_cosine(df, df.where("vec_id % 5 = 0"), k=4).collect():
        have.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    good = [(i, v / np.abs(v).max()) for i, v in usable(rows, False)]
    good = [(i, v / np.linalg.norm(v)) for i, v in good]
    hits = total = 0
    for q, x in good:
        if q % 5 == 0:
            scores = sorted((-round(float(x @ y), 9), i) for i, y in good if i != q and len(x) == len(y))[:4]
            got = sorted(have.get(q, []))
            assert [r for r, _, _ in got][: len(scores)] == list(range(1, len(scores) + 1))
            by_id = {i: y for i, y in good}
            assert all(abs(s - float(x @ by_id[i])) < 1e-9 for _, i, s in got if len(by_id[i]) == len(x))
            total += len(scores)
            hits += len({i for _, i in scores} & {i for _, i, _ in got})
    assert hits >= 0.9 * total
    copies = [i for _, i, _ in sorted(have[2000]) if i != 6000]
    assert copies[:3] == [0, 2001, 2002]
