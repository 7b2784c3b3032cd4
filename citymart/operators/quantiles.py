"""Quantiles per group, exact or approximate, that never gather a group in one task.

``percentile`` keeps every distinct value of a group in one buffer and ``percentile_approx`` merges
all partial sketches of a group in one task; both suffer when one group holds a third of the rows.
The exact method here counts instead of collecting. Values are mapped to buckets by a monotone
function, rows are counted per (group, bucket) with map-side combine, and only the bucket that holds
the wanted rank is looked at again, so the second scan shuffles a sliver of the data.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citymart.session import stage

# Buckets per e-fold of the value in the first scan; each refinement multiplies by the same number.
RESOLUTION = 2**8

# Stand-ins for NaN and infinity in sketches.
_LARGEST = sys.float_info.max
_NEXT_LARGEST = math.nextafter(_LARGEST, 0)

# Rank error of the sketches: rows of a group divided by this.
ACCURACY = 100_000

# Natural logarithms of doubles start near -745; the shift keeps bucket numbers of positives above 0.
_LOG_SHIFT = 746

# Beyond the bucket of any finite double at any resolution in use.
_NAN_BUCKET = 1 << 62


def _bucket(value: Column, resolution: int) -> Column:
    """Monotone bucket number: equal relative width on both sides of zero, zero on its own.

    Infinities have buckets of their own at the ends, NaN one behind them, as Spark sorts them.
    """
    infinite = F.lit(float("inf"))
    size = F.floor((F.log(F.abs(value)) + _LOG_SHIFT) * resolution).cast("long")
    return (
        F.when(F.isnan(value), F.lit(_NAN_BUCKET))
        .when(value == infinite, F.lit(_NAN_BUCKET - 1))
        .when(value == -infinite, F.lit(1 - _NAN_BUCKET))
        .when(value > 0, size)
        .when(value < 0, -size)
        .otherwise(F.lit(0).cast("long"))
    )


def _rank(prob: Column, total: Column, rule: str) -> Column:
    if rule == "disc":
        return F.greatest(F.lit(1), F.ceil(prob * total)).cast("long")
    if rule == "nearest":
        return (F.round(prob * (total - 1)) + 1).cast("long")
    raise ValueError(f"unknown rank rule {rule!r}")


def join_on(
    left: DataFrame,
    right: DataFrame,
    names: Sequence[str],
    how: str = "inner",
    also: Column | None = None,
) -> DataFrame:
    """Join on the named columns with NULL matching NULL; the keys come from the left side."""
    renamed = right.select(
        *[F.col(n).alias(f"__{n}") for n in names], *[c for c in right.columns if c not in names]
    )
    same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"__{n}")) for n in names])
    joined = left.join(renamed, same if also is None else same & also, how)
    return joined.drop(*[f"__{n}" for n in names])


def _count(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows per group of columns."""
    return cells.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def _running(counts: DataFrame, part: Sequence[str], order: str) -> DataFrame:
    """Counts summed per (part, order) with ``below``, the rows of the part before that order value.

    One shuffle on ``part`` serves both steps. A part has one row per distinct ``order`` value.
    """
    window = Window.partitionBy(*part).orderBy(order)
    return (
        counts.repartition(*part)
        .groupBy(*part, order)
        .agg(F.sum("n").alias("n"))
        .withColumn("below", F.sum("n").over(window) - F.col("n"))
    )


def _narrow(
    cells: DataFrame, grains: Sequence[Sequence[str]], spots: DataFrame, order: str
) -> list[DataFrame]:
    """Per grain, which ``order`` value inside its bucket each wanted rank falls on.

    ``spots`` says in which bucket a rank lies; rows outside these buckets drop out before the
    shuffle.
    """
    by_grain = [spots.filter(F.col("grain") == number) for number in range(len(grains))]
    wanted = cells
    hit = F.lit(len(grains) == 1)
    for number, (grain, spot) in enumerate(zip(grains, by_grain)):
        part = [*grain, "measure", "bucket"]
        if len(grains) == 1:
            wanted = join_on(wanted, spot.select(*part), part, "left_semi")
        else:
            flag = f"hit_{number}"
            marked = spot.select(*part).distinct().withColumn(flag, F.lit(True))
            wanted = join_on(wanted, marked, part, "left")
            hit = hit | F.coalesce(F.col(flag), F.lit(False))
    keys = list(dict.fromkeys(k for grain in grains for k in grain))
    counted = _count(wanted.filter(hit), [*keys, "measure", "bucket", order])
    found = []
    for grain, spot in zip(grains, by_grain):
        part = [*grain, "measure", "bucket"]
        here = (F.col("rank") > F.col("below")) & (F.col("rank") <= F.col("below") + F.col("n"))
        found.append(
            join_on(_running(counted, part, order), spot.select(*part, "out", "rank"), part, also=here)
            .withColumn("rank", F.col("rank") - F.col("below"))
        )
    return found


def group_quantiles(
    df: DataFrame,
    grains: Sequence[Sequence[str]],
    outputs: Mapping[str, tuple[str, float]],
    rule: str = "disc",
    refinements: int = 0,
) -> list[DataFrame]:
    """Exact quantiles for several grouping grains, in two scans of ``df`` as a rule.

    ``outputs`` maps a result column to ``(measure, probability)``. One frame per grain comes back,
    with the grain's keys and the result columns as doubles. NULLs are left out; infinities rank at
    the ends and NaN last. ``rule`` picks the row: ``disc`` takes rank ceil(p*n), ``nearest`` rank
    round(p*(n-1))+1.

    The first scan counts rows per bucket and finds the bucket of each wanted rank. These few rows
    are staged, so their true size decides how the next scan, which looks at the wanted buckets
    only, is joined to them; it sorts the different values of a wanted bucket, whose relative width is
    0.4 %, in one task. Each of the ``refinements`` is one more scan that first splits the wanted
    buckets into 256.
    """
    names = list(dict.fromkeys(k for grain in grains for k in grain))
    measures = list(dict.fromkeys(m for m, _ in outputs.values()))
    # Neutral key names, so that no key clashes with the columns used below.
    key_of = {name: f"key_{i}" for i, name in enumerate(names)}
    keys = list(key_of.values())
    key_types = {key_of[name]: df.schema[name].dataType for name in names}
    grains = [[key_of[name] for name in grain] for grain in grains]
    # Written as a generator, not as unpivot: the grains then reuse one shuffle of the counts.
    cells = [F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures]
    values = df.select(*[F.col(n).alias(k) for n, k in key_of.items()], F.inline(F.array(*cells)))
    values = values.filter(F.col("value").isNotNull())

    def staged(frames: list[DataFrame], bucket: str) -> DataFrame:
        tagged = [
            frame.select(
                F.lit(number).alias("grain"),
                *[(F.col(k) if k in grain else F.lit(None).cast(key_types[k])).alias(k) for k in keys],
                "measure",
                F.col(bucket).alias("bucket"),
                "out",
                "rank",
                "n",
            )
            for number, (grain, frame) in enumerate(zip(grains, frames))
        ]
        return stage(reduce(DataFrame.union, tagged), "ranks")

    asked = F.inline(
        F.array(
            *[
                F.struct(F.lit(out).alias("out"), F.lit(m).alias("asked"), F.lit(float(p)).alias("p"))
                for out, (m, p) in outputs.items()
            ]
        )
    )
    resolution = RESOLUTION
    cells = values.withColumn("bucket", _bucket(F.col("value"), resolution))
    histogram = _count(cells, [*keys, "measure", "bucket"])
    found = []
    for grain in grains:
        part = [*grain, "measure"]
        total = F.sum("n").over(Window.partitionBy(*part))
        found.append(
            _running(histogram, part, "bucket")
            .withColumn("total", total)
            .select("*", asked)
            .filter(F.col("asked") == F.col("measure"))
            .withColumn("rank", _rank(F.col("p"), F.col("total"), rule) - F.col("below"))
            .filter((F.col("rank") > 0) & (F.col("rank") <= F.col("n")))
        )
    spots = staged(found, "bucket")
    for _ in range(refinements):
        resolution *= RESOLUTION
        finer = cells.withColumn("finer", _bucket(F.col("value"), resolution))
        spots = staged(_narrow(finer, grains, spots, "finer"), "finer")
        cells = values.withColumn("bucket", _bucket(F.col("value"), resolution))
    name_of = {key: name for name, key in key_of.items()}
    return [
        frame.groupBy(*[F.col(k).alias(name_of[k]) for k in grain]).agg(
            *[F.max(F.when(F.col("out") == out, F.col("value"))).alias(out) for out in outputs]
        )
        for grain, frame in zip(grains, _narrow(cells, grains, spots, "value"))
    ]


def sketches(outputs: Mapping[str, tuple[str, float]], accuracy: int = ACCURACY) -> list[Column]:
    """The same results as aggregates for any grouping, from sketches merged map-side.

    The rank is off by at most n / ``accuracy``, so groups of less than half of ``accuracy`` rows are
    exact; a sketch takes up to some 24 bytes times ``accuracy``.
    """
    infinite, found = float("inf"), []
    for out, (measure, p) in outputs.items():
        value = F.col(measure).cast("double")
        # Sketches cannot order NaN, nor what stands above the largest number that takes its place.
        value = F.when(F.isnan(value), _LARGEST).when(value == infinite, _NEXT_LARGEST).otherwise(value)
        value = F.percentile_approx(value, p, accuracy)
        value = F.when(value == _LARGEST, float("nan")).when(value == _NEXT_LARGEST, infinite).otherwise(value)
        found.append(value.alias(out))
    return found


def group_stats(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[Column],
    outputs: Mapping[str, tuple[str, float]],
    exact: bool = False,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Aggregates and quantiles per group: one scan with sketches, three with exact quantiles."""
    if not exact:
        return df.groupBy(*keys).agg(*measures, *sketches(outputs, accuracy))
    [found] = group_quantiles(df, [keys], outputs)
    return join_on(df.groupBy(*keys).agg(*measures), found, keys, "left")
