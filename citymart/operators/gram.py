"""Correlations of many columns from one blocked matrix product a task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citymart.functions.schema import numeric_columns

# Columns are taken in blocks of so many; a task holds one row batch and the sums of all pairs of blocks.
BLOCK = 64


def _sums(left: tuple[np.ndarray, ...], right: tuple[np.ndarray, ...]) -> list[np.ndarray]:
    """For every pair of a left and a right column, over the rows that know both: rows, sums of both, of their squares
    and products, and how many of the rows hold a value that is not finite."""
    (x, known_x, odd_x), (y, known_y, odd_y) = left, right
    return [
        known_x.T @ known_y,
        x.T @ known_y,
        known_x.T @ y,
        (x * x).T @ known_y,
        known_x.T @ (y * y),
        x.T @ y,
        odd_x.T @ known_y + known_x.T @ odd_y,
    ]


def gram_correlations(df: DataFrame, columns: Sequence[str] | None = None, block: int = BLOCK) -> DataFrame:
    """Pearson correlation of every pair of columns: ``(col_a, col_b, r)``, what ``profile.correlation_matrix`` gives.

    Each task multiplies its rows by themselves, block by block of columns, and gives out one row per pair of blocks; these
    are added up over all tasks. So a plan has six sums whatever the number of columns, where one aggregate per
    pair would be c * (c + 1) / 2 of them in one operator. A pair counts over the rows where both values are known. NULL
    where one of them never varies; NaN where one is infinite or NaN. Columns are shifted by their means first, so
    that large values do not swallow the variance. ``df`` is read twice. All numeric columns by default.
    """
    columns = list(columns or numeric_columns(df))
    if len(columns) < 2:
        raise ValueError("correlation needs at least two numeric columns")
    doubles = [F.col("`" + c.replace("`", "``") + "`").cast("double").alias(f"c_{i}") for i, c in enumerate(columns)]
    numbers = df.select(*doubles)
    finite = [F.when(F.abs(F.col(c)) < float("inf"), F.col(c)) for c in numbers.columns]
    shift = np.array([m or 0.0 for m in numbers.agg(*[F.avg(f) for f in finite]).first()])
    starts = range(0, len(columns), block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], list[np.ndarray]] = {}
        for batch in batches:
            values = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            known = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            odd = known * ~np.isfinite(values)
            values = np.where((known > 0) & np.isfinite(values), values - shift, 0.0)
            parts = {s: (values[:, s : s + block], known[:, s : s + block], odd[:, s : s + block]) for s in starts}
            for a in starts:
                for b in starts:
                    if a <= b:
                        found = _sums(parts[a], parts[b])
                        before = totals.get((a, b))
                        totals[a, b] = found if before is None else [p + q for p, q in zip(before, found)]
        for (a, b), sums in totals.items():
            place_a, place_b = np.indices(sums[0].shape)
            data = [place_a.ravel() + a, place_b.ravel() + b, *(s.ravel() for s in sums)]
            keep = data[0] <= data[1]
            arrays = [pa.array(d[keep], pa.int32() if k < 2 else pa.float64()) for k, d in enumerate(data)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["a", "b", "n", "x", "y", "xx", "yy", "xy", "odd"]
    kinds = ["int", "int", *["double"] * 7]
    sums = numbers.mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
    total = sums.groupBy("a", "b").agg(*[F.sum(n).alias(n) for n in names[2:]])
    n = F.col("n")
    # a column that does not vary leaves rounding errors only
    spread = {v: F.col(f"{v}{v}") - F.col(v) * F.col(v) / n for v in "xy"}
    varies = {v: F.when(spread[v] > 1e-12 * F.col(f"{v}{v}"), spread[v]) for v in "xy"}
    r = (F.col("xy") - F.col("x") * F.col("y") / n) / F.sqrt(varies["x"] * varies["y"])
    r = F.when(F.col("odd") > 0, F.lit(float("nan"))).when(n > 0, r)
    cells = total.select("a", "b", r.alias("r"))
    mirrored = cells.filter("a < b").select(F.col("b").alias("a"), F.col("a").alias("b"), "r")
    title = F.array(*[F.lit(c) for c in columns])
    found = cells.unionByName(mirrored)
    return found.select(F.get(title, F.col("a")).alias("col_a"), F.get(title, F.col("b")).alias("col_b"), "r")
