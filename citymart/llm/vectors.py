"""Vector columns in numpy: decoding, pivots, and blocks that tasks read one after another."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that pivots are chosen from.
PIVOT_SAMPLE = 4096


def is_finite(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    big = F.lit(float("inf"))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == big))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True))


def one_per_id(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``vector``: of rows that repeat an id, the smallest vector that is not NULL."""
    rows = df.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    return rows.groupBy("id").agg(F.min("vector").alias("vector"))


def to_matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix of doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by the power of two next to their largest component: squares stay in range, and
    no digit changes."""
    _, exponent = np.frexp(np.abs(x).max(axis=1, keepdims=True))
    return np.ldexp(x, -exponent)


def by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, row numbers and matrix of the vectors of each length."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        yield int(n), rows, to_matrix(column.take(pa.array(rows)))


def sample(df: DataFrame, rows: int = PIVOT_SAMPLE) -> list[np.ndarray]:
    """At most ``rows`` vectors by the hash of their id, the most frequent lengths first."""
    taken = df.select("id", "vector").orderBy(F.xxhash64("id"), "id").limit(rows).collect()
    found: dict[int, list] = {}
    for r in taken:
        found.setdefault(len(r.vector), []).append(r.vector)
    return [np.array(v, np.float64) for _, v in sorted(found.items(), key=lambda x: -len(x[1]))]


def spread(points: np.ndarray, count: int) -> np.ndarray:
    """``count`` of the points, each in turn the one farthest from those chosen before."""
    chosen = [0]
    nearest = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(points)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, bool, pa.RecordBatch]]:
    """Runs of equal ``cell``, ``part`` and ``role`` in sorted batches, with whether a new (cell, part)
    begins and whether the run is of role 0. A run may come in several pieces."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("cell", "part", "role")])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            at = tuple(keys[:2, start])
            yield at != last, keys[2, start] == 0, batch.slice(start, end - start)
            last = at
