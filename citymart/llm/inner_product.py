"""Exact top-k by inner product: cover trees over queries and data, searched together."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citymart.llm.vectors import blocks, by_length, is_finite, one_per_id, sample, spread, to_matrix
from citymart.session import stage

#: Rows of data that a task holds, queries searched together.
BLOCK_ROWS = 16_384
QUERY_ROWS = 1024
LEAST_CELLS, MOST_CELLS = 8, 1024
FAN, DATA_LEAF, QUERY_LEAF = 16, 256, 64
EXACT = 2.0**53


class CoverTree:
    """Nodes with a point as centre and the covering radius of their points.

    A node's children are centred at points that are far apart, each in turn the farthest from those
    before, until all points are within half the node's radius of one or there are ``FAN``; every
    point goes to the nearest. Radii are measured, so that each node covers all its points exactly.
    """

    def __init__(self, x: np.ndarray, leaf: int):
        self.centre: list[np.ndarray] = []
        self.radius: list[float] = []
        self.children: list[list[int]] = []
        self.points: list[np.ndarray] = []
        self.parent: list[int] = []
        todo = [(np.arange(len(x)), x[0], -1)]
        while todo:
            points, centre, parent = todo.pop()
            node = len(self.centre)
            distance = np.linalg.norm(x[points] - centre, axis=1)
            self.centre.append(centre)
            self.radius.append(float(distance.max()))
            self.children.append([])
            self.points.append(points)
            self.parent.append(parent)
            if parent >= 0:
                self.children[parent].append(node)
            if len(points) <= leaf or not distance.max():
                continue
            chosen, owner, nearest = [int(distance.argmin())], np.zeros(len(points), np.int64), None
            nearest = np.linalg.norm(x[points] - x[points[chosen[0]]], axis=1)
            while len(chosen) < FAN and nearest.max() > self.radius[node] / 2:
                far = int(nearest.argmax())
                from_far = np.linalg.norm(x[points] - x[points[far]], axis=1)
                owner[from_far < nearest] = len(chosen)
                nearest = np.minimum(nearest, from_far)
                chosen.append(far)
            if len(chosen) > 1:
                todo += [(points[owner == i], x[points[c]], node) for i, c in enumerate(chosen) if (owner == i).any()]
        self.centres, self.radii = np.array(self.centre), np.array(self.radius)
        self.lengths = np.linalg.norm(self.centres, axis=1)


class Search:
    """The best ``k`` of a block's rows for a group of queries, by score and then by smaller id."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, tree: CoverTree, query_ids: np.ndarray, q: np.ndarray, k: int):
        self.ids, self.x, self.tree, self.query_ids, self.q, self.k = ids, x, tree, query_ids, q, k
        self.queries = CoverTree(q, QUERY_LEAF)
        self.scores = np.full((len(q), k), -np.inf)
        self.found = np.full((len(q), k), np.iinfo(np.int64).max)
        self.worst = np.full(len(self.queries.centre), -np.inf)
        self._visit(0, np.array([0]))

    def _bounds(self, node: int, others: np.ndarray) -> np.ndarray:
        """No pair of points of the nodes has a larger product (with room for rounding)."""
        a, b = self.queries, self.tree
        bound = b.centres[others] @ a.centres[node] + a.lengths[node] * b.radii[others]
        bound += a.radii[node] * (b.lengths[others] + b.radii[others])
        return bound + 1e-9 * (1 + np.abs(bound) + a.lengths[node] * b.lengths[others])

    def _visit(self, node: int, others: np.ndarray) -> None:
        """All data nodes in ``others`` that may improve a query of ``node``, the most promising first."""
        while True:
            bounds = self._bounds(node, others)
            keep = bounds >= self.worst[node]
            others, bounds = others[keep], bounds[keep]
            if not len(others):
                return
            if self.queries.children[node]:
                for child in self.queries.children[node]:
                    self._visit(child, others)
                self.worst[node] = min(self.worst[c] for c in self.queries.children[node])
                return
            inner = [c for o in others for c in self.tree.children[o]]
            if not inner:
                break
            others = np.array([o for o in others if not self.tree.children[o]] + inner)
        for other in others[np.argsort(-bounds, kind="stable")]:
            if self._bounds(node, np.array([other]))[0] >= self.worst[node]:
                self._compare(self.queries.points[node], self.tree.points[other])
                self.worst[node] = self.scores[self.queries.points[node], -1].min()

    def _compare(self, queries: np.ndarray, points: np.ndarray) -> None:
        scores, ids = self.q[queries] @ self.x[points].T, self.ids[points]
        better = (scores >= self.scores[queries, -1:]) & (ids != self.query_ids[queries, None])
        for row in np.flatnonzero(better.any(axis=1)):
            hits, query = np.flatnonzero(better[row]), queries[row]
            all_scores = np.concatenate([self.scores[query], scores[row, hits]])
            all_ids = np.concatenate([self.found[query], ids[hits]])
            best = np.lexsort((all_ids, -all_scores))[: self.k]
            self.scores[query], self.found[query] = all_scores[best], all_ids[best]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        there = np.isfinite(self.scores)
        return np.repeat(self.query_ids, there.sum(axis=1)), self.found[there], self.scores[there].astype(np.int64)


def _in_full(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int) -> tuple:
    """The same where products are beyond exact doubles, one query at a time in whole numbers; scores
    beyond 64 bits are held at the limit."""
    out: tuple[list, list, list] = ([], [], [])
    whole = [[int(v) for v in row] for row in x]
    for query_id, query in zip(query_ids, q):
        query = [int(v) for v in query]
        scores = [(-sum(a * b for a, b in zip(query, row)), int(i)) for i, row in zip(ids, whole) if i != query_id]
        for score, i in sorted((max(-(2**63) + 1, min(2**63 - 1, s)), i) for s, i in scores)[:k]:
            out[0].append(query_id)
            out[1].append(i)
            out[2].append(-score)
    return tuple(np.array(c, np.int64) for c in out)


def quantised(x: np.ndarray, scale: float) -> np.ndarray:
    return np.floor(scale * x)


def _search_blocks(scale: float, k: int):
    names = ["query_id", "vec_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, x, tree = [], [], None, None
        for new, own, part in blocks(batches):
            if new:
                ids, vectors, tree = [], [], None
            part_ids = part.column(part.schema.get_field_index("id")).to_numpy(zero_copy_only=False)
            vector = part.column(part.schema.get_field_index("vector"))
            if own:
                ids.append(part_ids)
                vectors.append(quantised(to_matrix(vector), scale))
                continue
            if not ids:
                continue
            if tree is None:
                all_ids, x = np.concatenate(ids), np.concatenate(vectors)
                tree = CoverTree(x, DATA_LEAF)
            for n, at, q in by_length(vector):
                if n != x.shape[1]:
                    continue
                q = quantised(q, scale)
                for start in range(0, len(q), QUERY_ROWS):
                    some = slice(start, start + QUERY_ROWS)
                    if np.abs(x).max() * np.abs(q[some]).max() * n < EXACT:
                        rows = Search(all_ids, x, tree, part_ids[at][some], q[some], k).rows()
                    else:
                        rows = _in_full(all_ids, x, part_ids[at][some], q[some], k)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows], names=names)

    return run


def _assign(rows: DataFrame, pivots: list[np.ndarray]) -> DataFrame:
    """Adds ``cell``, the nearest pivot; lengths have cells of their own."""
    first = np.cumsum([0] + [len(p) for p in pivots])
    known = {p.shape[1]: (int(at), p) for at, p in zip(first, pivots)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.zeros(batch.num_rows, np.int64)
            for n, at, x in by_length(batch.column(1)):
                if n not in known:
                    cells[at] = -1 - n
                    continue
                base, own = known[n]
                cells[at] = base + ((own**2).sum(axis=1) - 2 * x @ own.T).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], names=["id", "vector", "cell"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"id {kinds['id']}, vector {kinds['vector']}, cell bigint")


def top_products(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = 50,
    k: int = 5,
    scale: float = 256.0,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id``, ``score``: the ``k`` best rows of each query, itself left out.

    Queries are the rows whose id is divisible by ``every``, candidates all rows. Components become
    floor(``scale`` x), the score is the integer inner product, held at the limits of a long beyond
    them, ties go to the smaller id. Vectors that are NULL or empty or hold a NULL or non-finite
    component take no part, nor do vectors of
    different lengths with each other; a query without candidates has no rows. Rows without an id are
    left out; of rows that repeat an id the smallest vector counts. Other columns are ignored. An
    empty table gives no rows.

    Rows near the same pivot share a block, and a cell of more than ``block_rows`` rows is dealt to
    several. A task builds a cover tree of its block and one of each group of queries, and drops pairs
    of nodes whose centres and covering radii bound every product below the group's worst kth score.
    Queries are copied to each block, ``k`` rows a query leave it, so no task holds more than a block
    and a group of queries.
    """
    rows = one_per_id(df, id_col, vector_col).filter(is_finite("vector")).filter(F.size("vector") > 0)
    rows = stage(rows, "vectors")
    pivots = min(MOST_CELLS, max(LEAST_CELLS, -(-rows.count() // block_rows)))
    cells = stage(_assign(rows, [spread(x, pivots) for x in sample(rows)]), "cells")
    sizes = cells.groupBy("cell").agg(F.ceil(F.count("*") / block_rows).cast("long").alias("parts"))
    sizes = stage(sizes, "sizes")
    own = cells.join(sizes, "cell").select(
        "id", "vector", "cell", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), F.lit(0).alias("role")
    )
    # the blocks' numbers, copied to the queries as one array: MOST_CELLS cells and their parts
    places = sizes.select("cell", F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1)).alias("part"))
    places = [(r.cell, r.part) for r in places.collect()]
    asked = rows.filter(F.col("id") % every == 0)
    at = F.array(*[F.struct(F.lit(c).alias("cell"), F.lit(p).alias("part")) for c, p in places]) if places else None
    if places:
        asked = asked.select("id", "vector", F.explode(at).alias("at"))
        asked = asked.select("id", "vector", F.col("at.cell").cast("long").alias("cell"), F.col("at.part").alias("part"), F.lit(1).alias("role"))
        own = own.unionByName(asked)
    own = own.repartition("cell", "part").sortWithinPartitions("cell", "part", "role")
    kind = rows.schema["id"].dataType.simpleString()
    found = own.mapInArrow(_search_blocks(scale, k), f"query_id {kind}, vec_id {kind}, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
