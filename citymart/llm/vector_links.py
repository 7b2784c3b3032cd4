"""Near-duplicate vectors: an exact metric range join over cells around pivots."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citymart.llm.components import connected_components
from citymart.llm.vectors import blocks, by_length, is_finite, one_per_id, sample, scaled, spread, to_matrix
from citymart.session import stage

#: Rows that a task holds of a cell; larger cells are dealt to several tasks.
BLOCK_ROWS = 8192
#: Rows compared with a block at a time.
PROBE_ROWS = 1024
LEAST_PIVOTS, MOST_PIVOTS = 8, 1024
#: Room for rounding when a distance only rules out.
SLACK = 1e-6


def _unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def reachable_cells(x: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Nearest pivot of each unit vector, and the later cells that a vector within ``radius`` may lie in.

    A vector in cell j is no farther from pivot j than from any other. By the triangle inequality
    x reaches it only if d(x, j) <= d(x, i) + 2 radius, and, as cells are cut by the planes half-way
    between pivots, only if x is at most ``radius`` from that plane. A pair of cells meets in the
    later one.
    """
    near = x @ pivots.T
    own = near.argmax(axis=1)
    distance = np.sqrt(np.maximum(0, 2 - 2 * near))
    between = np.sqrt(np.maximum(0, 2 - 2 * (pivots @ pivots.T)))[own]
    mine = np.take_along_axis(near, own[:, None], 1)
    fits = distance <= np.take_along_axis(distance, own[:, None], 1) + 2 * radius + SLACK
    fits &= mine - near <= (radius + SLACK) * between + SLACK
    fits &= np.arange(len(pivots)) > own[:, None]
    return own, fits


def assign_cells(rows: DataFrame, pivots: list[np.ndarray], radius: float) -> DataFrame:
    """Adds ``cell`` and the ``others`` a vector must be copied to. Lengths have cells of their own."""
    first = np.cumsum([0] + [len(p) for p in pivots])
    known = {p.shape[1]: (int(at), p) for at, p in zip(first, pivots)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.zeros(batch.num_rows, np.int64)
            others: list = [[]] * batch.num_rows
            vectors = batch.column(1)
            for n, at, x in by_length(vectors):
                if n not in known:  # too rare for the sample: one cell
                    cells[at] = -1 - n
                    continue
                base, own_pivots = known[n]
                own, fits = reachable_cells(_unit(x), own_pivots, radius)
                cells[at] = own + base
                for row, fit in zip(at.tolist(), fits):
                    others[row] = (np.flatnonzero(fit) + base).tolist()
            columns = [batch.column(0), vectors, pa.array(cells), pa.array(others, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "vector", "cell", "others"])

    kind = rows.schema["vector"].dataType.simpleString()
    id_kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "vector").mapInArrow(run, f"id {id_kind}, vector {kind}, cell bigint, others array<bigint>")


class Block:
    """The rows a task holds, their numbers of links, and which of them are connected."""

    def __init__(self, ids: list[np.ndarray], vectors: list[np.ndarray], cosine: float):
        self.ids, x = np.concatenate(ids), scaled(np.concatenate(vectors))
        self.x, self.norm, self.cosine = x, np.linalg.norm(x, axis=1), cosine
        self.small = (x / self.norm[:, None]).astype(np.float32)
        self.links = np.zeros(len(x), np.int64)
        self.group = np.arange(len(x))
        for start in range(0, len(x), PROBE_ROWS):
            rows = np.arange(start, min(start + PROBE_ROWS, len(x)))
            self._probe(self.x[rows], self.norm[rows], self.small[rows], rows)

    def _linked(self, x: np.ndarray, norm: np.ndarray, small: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows with a link, and their links: single precision rules out, double precision decides."""
        least = self.cosine - 1e-4 - x.shape[1] * 1e-6
        rows = np.flatnonzero((small @ self.small.T).max(axis=1) >= least)
        return rows, (x[rows] @ self.x.T) / (norm[rows, None] * self.norm) >= self.cosine

    def _join(self, hits: np.ndarray) -> int:
        """Connects the rows hit and returns the group's smallest row."""
        groups = np.unique(self.group[hits])
        if len(groups) > 1:
            self.group[np.isin(self.group, groups[1:])] = groups[0]
        return int(groups[0])

    def _probe(self, x: np.ndarray, norm: np.ndarray, small: np.ndarray, own: np.ndarray | None) -> tuple:
        rows, linked = self._linked(x, norm, small)
        if own is not None:
            linked[np.arange(len(rows)), own[rows]] = True  # itself, whatever rounding says
        met = [self._join(np.flatnonzero(hits)) for hits in linked if hits.any()]
        found = linked.any(axis=1)
        if own is not None:
            self.links[own[rows]] += linked.sum(axis=1) - 1
        else:
            self.links += linked.sum(axis=0)
        return rows[found], linked[found].sum(axis=1), met

    def probe(self, ids: np.ndarray, x: np.ndarray) -> Iterator[tuple]:
        """Links of other rows to the block's: id, one row linked, number of links."""
        x = scaled(x)
        for start in range(0, len(ids), PROBE_ROWS):
            part = slice(start, start + PROBE_ROWS)
            norm = np.linalg.norm(x[part], axis=1)
            rows, counts, met = self._probe(x[part], norm, (x[part] / norm[:, None]).astype(np.float32), None)
            if len(rows):
                yield ids[part][rows], self.ids[met], counts

    def own(self) -> tuple:
        """The same for the block's rows; each names a row of its group."""
        rows = np.flatnonzero((self.links > 0) | (self.group != np.arange(len(self.ids))))
        return self.ids[rows], self.ids[self.group[rows]], self.links[rows]


def _count_links(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "n"]
        block, ids, vectors = None, [], []
        for new, own, run in blocks(batches):
            if new:
                if ids and block is None:
                    block = Block(ids, vectors, cosine)
                if block:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in block.own()], names=names)
                block, ids, vectors = None, [], []
            run_ids = run.column(run.schema.get_field_index("id")).to_numpy(zero_copy_only=False)
            x = to_matrix(run.column(run.schema.get_field_index("vector")))
            if own:
                ids.append(run_ids)
                vectors.append(x)
            elif ids:
                block = block or Block(ids, vectors, cosine)
                for found in block.probe(run_ids, x):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=names)
        if ids and block is None:
            block = Block(ids, vectors, cosine)
        if block:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in block.own()], names=names)

    return run


def vector_links(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.95, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """One row per id: ``id_col``, ``n_links``, ``component_id``, ``kept``.

    Vectors whose cosine, in double precision, is at least ``cosine`` (above 0) are linked.
    ``n_links`` counts the others linked directly, ``component_id`` is the smallest id reachable,
    ``kept`` marks that row. NULL, empty and zero vectors and those with a NULL or non-finite
    component have no links, nor have vectors of different lengths with each other. Rows without an
    id are left out; of rows that repeat an id the smallest vector counts. Other columns are
    ignored. An empty table gives no rows.

    Pivots, spread over a sample, cut space into cells; a vector is copied to the later cells that
    its neighbours may lie in. Cells of more than ``block_rows`` rows are dealt to several blocks,
    and each pair of blocks meets once. A task keeps one block and streams the copies past it; what
    leaves it is one row per linked vector, never pairs. Where vectors are spread evenly over many
    dimensions no partition by distance helps, and the work stays quadratic, as blocked products.
    """
    # the cosine's bound on the distance of unit vectors
    radius = float(np.sqrt(2 - 2 * cosine))
    every = one_per_id(df, id_col, vector_col)
    some = F.exists("vector", lambda x: x != 0)
    valid = stage(every.filter(is_finite("vector")).filter(some), "vectors")
    count = valid.count()
    pivots = min(MOST_PIVOTS, max(LEAST_PIVOTS, -(-count // block_rows)))
    chosen = [spread(_unit(x), pivots) for x in sample(valid)]
    cells = stage(assign_cells(valid, chosen, radius), "cells")
    sizes = {r.cell: r.n for r in cells.groupBy("cell").agg(F.count("*").alias("n")).filter(F.col("n") > block_rows).collect()}
    # cells of one block are not listed: at most count / block_rows entries
    parts = F.create_map(*[F.lit(v) for c, n in sizes.items() for v in (c, -(-n // block_rows))]) if sizes else None

    def parts_of(cell):
        return F.coalesce(parts[cell], F.lit(1)) if sizes else F.lit(1)

    own = cells.withColumn("part", F.pmod(F.xxhash64("id"), parts_of(F.col("cell"))).cast("int"))
    place = lambda cell, part, role: F.struct(cell.alias("cell"), part.cast("int").alias("part"), F.lit(role).alias("role"))
    mine = F.array(place(F.col("cell"), F.col("part"), 0))
    before = F.transform(F.expr("sequence(0, part - 1)"), lambda p: place(F.col("cell"), p, 1))
    before = F.when(F.col("part") > 0, before).otherwise(F.expr("array()"))
    copies = F.flatten(F.transform("others", lambda c: F.transform(F.sequence(F.lit(0), parts_of(c) - 1), lambda p: place(c, p, 1))))
    placed = own.select("id", "vector", F.explode(F.concat(mine, before, copies)).alias("at")).select("id", "vector", "at.*")
    placed = placed.repartition("cell", "part").sortWithinPartitions("cell", "part", "role")
    id_kind = valid.schema["id"].dataType.simpleString()
    found = stage(placed.mapInArrow(_count_links(cosine), f"a {id_kind}, b {id_kind}, n bigint"), "links")
    groups = connected_components(found.select("a", "b"))
    totals = found.groupBy("a").agg(F.sum("n").alias("n"))
    return (
        every.select("id")
        .join(totals, F.col("id") == F.col("a"), "left")
        .join(groups, F.col("id") == F.col("node"), "left")
        .select(
            F.col("id").alias(id_col),
            F.coalesce("n", F.lit(0)).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
            (F.col("id") == F.coalesce("component", "id")).alias("kept"),
        )
    )
