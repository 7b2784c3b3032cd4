"""Newest rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citymart.session import stage


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    basis: Column | None = None,
    staged: bool = False,
) -> DataFrame:
    """Rows of ``df`` whose ``order`` is the newest of their key, ties kept, plus ``latest_<order>``.

    With ``basis`` the newest value is looked up among the rows that satisfy it, yet all rows of
    that value come back. Keys or orders that are NULL drop out.

    An aggregate and a join instead of a ranking window: the maximum combines map-side and the join
    can be broadcast or skew-split, whereas a window would sort a hot key in one task. ``staged``
    stores the maxima first; for a large ``df`` with few keys their known size saves its shuffle.
    """
    newest_name = f"latest_{order}"
    newest = (
        (df if basis is None else df.filter(basis))
        .groupBy(*[F.col(k).alias(f"__{k}") for k in keys])
        .agg(F.max(order).alias(newest_name))
    )
    if staged:
        newest = stage(newest, "newest")
    same = F.col(order) == F.col(newest_name)
    for key in keys:
        same = same & (F.col(key) == F.col(f"__{key}"))
    return df.join(newest, same).drop(*[f"__{k}" for k in keys])


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the largest ``order`` values, ties by the largest other columns.

    NULL keys are keys like any other, NULL orders come first. The winner is an aggregate of whole
    rows, combined map-side, so copies of a key meet as one row per task. Maps cannot be compared and
    are not taken.
    """
    others = [c for c in df.columns if c not in (*keys, *order)]
    newest = F.max(F.struct(*order, *others)).alias("__newest")
    found = df.groupBy(*keys).agg(newest)
    return found.select(*[F.col(c) if c in keys else F.col(f"__newest.{c}").alias(c) for c in df.columns])
