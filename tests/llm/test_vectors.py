"""Vector links and exact top products against brute force."""

import numpy as np
import pytest

from citymart.llm import inner_product
from citymart.llm.inner_product import CoverTree, top_products
from citymart.llm.vector_links import reachable_cells, vector_links

SCHEMA = "vec_id long, embedding array<double>, cell int, part string"


def clustered(n=500, dim=12, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    x = rng.normal(size=(n, dim))
    hot = rng.random(n) < 0.4
    x[hot] = centres[0] + 0.06 * rng.normal(size=(hot.sum(), dim)) * np.linalg.norm(centres[0])
    for i in np.flatnonzero(~hot)[: n // 4]:
        x[i] = centres[rng.integers(1, 12)] + 0.3 * rng.normal(size=dim)
    x[7] = x[8]
    x[9] = 5 * x[8]
    ids = rng.permutation(3 * n)[:n]
    return ids, x


def frame(spark, ids, x, kind="double"):
    rows = [(None if i is None else int(i), None if v is None else [None if c is None else float(c) for c in v], 5, "p") for i, v in zip(ids, x)]
    return spark.createDataFrame(rows, SCHEMA.replace("double", kind))


def plain_links(ids, x, cosine=0.95):
    x = np.asarray(x, float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = unit @ unit.T >= cosine
    np.fill_diagonal(linked, False)
    group = np.array(ids)
    for _ in ids:
        group = np.array([min([group[i], *group[linked[i]]]) for i in range(len(ids))])
    return {(int(i), int(linked[k].sum()), int(group[k])) for k, i in enumerate(ids)}


@pytest.mark.parametrize("cosine, block_rows", [(0.95, 8192), (0.95, 40), (0.7, 60), (0.99, 25)])
def test_links_equal_brute_force(spark, cosine, block_rows):
    ids, x = clustered()
    found = vector_links(frame(spark, ids, x).repartition(5), cosine=cosine, block_rows=block_rows).collect()
    assert {(r.vec_id, r.n_links, r.component_id) for r in found} == plain_links(ids, x, cosine)
    assert len(found) == len(ids) and all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_links_of_single_precision_and_of_any_size(spark):
    ids, x = clustered(200, seed=4)
    x = x.astype(np.float32)
    found = vector_links(frame(spark, ids, x, "float")).collect()
    assert {(r.vec_id, r.n_links, r.component_id) for r in found} == plain_links(ids, x)
    scale = np.repeat([1e-300, 1.0, 1e300, 1e-12], 50)[:, None]
    found = vector_links(frame(spark, ids, x.astype(float) * scale)).collect()
    assert {(r.vec_id, r.n_links, r.component_id) for r in found} == plain_links(ids, x)


def test_exact_threshold(spark):
    x = [[1.0, 0.0], [0.6, 0.8], [3.0, 4.0], [0.0, 2.0]]
    found = {r.vec_id: r.n_links for r in vector_links(frame(spark, range(4), x), cosine=0.6).collect()}
    assert found == {0: 2, 1: 3, 2: 3, 3: 2}


def test_cells_reach_every_neighbour():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    pivots, radius = x[:20], 0.3
    own, fits = reachable_cells(x, pivots, radius)
    close = np.linalg.norm(x[:, None] - x[None], axis=2) <= radius
    for i, j in zip(*np.nonzero(close)):
        if own[i] < own[j]:
            assert fits[i, own[j]]
    assert fits.mean() < 0.3  # and not just every cell


def test_odd_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    ids = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 10, 11, None, 12]
    x = [[1, 0], None, [0, 0], [], [nan, 1], [inf, 1], [1, None], [1, 0, 0], [1, 0.01], [0, 1], None, [0, 1], [1, 0], [2, 0, 0]]
    found = {tuple(r) for r in vector_links(frame(spark, ids, x)).collect()}
    lone = {(i, 0, i, True) for i in (2, 3, 4, 5, 6, 7)}
    assert found == lone | {(1, 1, 1, True), (9, 1, 1, False), (8, 1, 8, True), (12, 1, 8, False), (10, 1, 10, True), (11, 1, 10, False)}


def plain_top(ids, x, every=50, k=5):
    whole = [[int(np.floor(256 * c)) for c in row] for row in x]
    found = set()
    for i, q in zip(ids, whole):
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, w)), j) for j, w in zip(ids, whole) if j != i)
            found |= {(int(i), rank + 1, int(j), -s) for rank, (s, j) in enumerate(scores[:k])}
    return found


@pytest.mark.parametrize("block_rows, every, k", [(16_384, 50, 5), (60, 7, 3), (60, 1, 1)])
def test_top_products_equal_brute_force(spark, monkeypatch, block_rows, every, k):
    monkeypatch.setattr(inner_product, "LEAST_CELLS", 4)
    ids, x = clustered(300, seed=6)
    x = np.round(x, 1)  # many ties
    found = top_products(frame(spark, ids, x).repartition(4), every=every, k=k, block_rows=block_rows)
    assert {tuple(r) for r in found.collect()} == plain_top(ids, x, every, k)
    assert found.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]


def test_products_beyond_exact_doubles(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(60, 4)) * 1e6)
    assert {tuple(r) for r in top_products(frame(spark, range(60), x), every=20).collect()} == plain_top(range(60), x, 20)


def test_cover_tree_covers():
    _, x = clustered(400, seed=8)
    tree = CoverTree(x, 20)
    for node, points in enumerate(tree.points):
        assert np.linalg.norm(x[points] - tree.centre[node], axis=1).max() <= tree.radius[node] + 1e-12
        if tree.children[node]:
            below = np.concatenate([tree.points[c] for c in tree.children[node]])
            assert sorted(below) == sorted(points)
    assert len(tree.centre) > 20


def test_odd_vectors_take_no_part(spark):
    nan = float("nan")
    ids = [0, 50, 100, 150, 200, 1, 2, 3, 3, None]
    x = [[1, 0], None, [nan, 1], [], [1, None], [0.5, 0], [1, 1, 1], [0.5, 0], [9, 9], [7, 7]]
    found = [tuple(r) for r in top_products(frame(spark, ids, x)).collect()]
    assert sorted(found) == [(0, 1, 1, 256 * 128), (0, 2, 3, 256 * 128)]


def test_empty_tables(spark):
    empty = frame(spark, [], [])
    assert vector_links(empty).collect() == [] and top_products(empty).collect() == []
    nothing = frame(spark, [0, 1], [None, [0, 0]])
    assert {tuple(r) for r in vector_links(nothing).collect()} == {(0, 0, 0, True), (1, 0, 1, True)}
    assert top_products(nothing).collect() == []
