"""Sketch tables beside the marts: built once, refreshed by neighbourhood, read at any grain."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from citymart.operators import rollups
from citymart.sources import tables

#: Sketch table, the formatted table it comes from, and what builds it.
ROLLUPS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "price_sketches": ("idealista", rollups.price_sketches),
    "site_sketches": ("cultural_sites", rollups.site_sketches),
}


def build_rollups(
    spark: SparkSession, formatted_zone: str, exploitation_zone: str, fmt: str = tables.DEFAULT_FORMAT
) -> None:
    """Both sketch tables from the whole formatted tables, one scan each."""
    for name, (source, build) in ROLLUPS.items():
        rows = tables.read_mart(spark, formatted_zone, source, fmt)
        tables.write_table(build(rows), f"{exploitation_zone}/{name}", fmt=fmt, versioned=True)


def refresh_rollups(
    spark: SparkSession,
    formatted_zone: str,
    exploitation_zone: str,
    changed: Sequence[tuple[str, str]],
    fmt: str = tables.DEFAULT_FORMAT,
) -> None:
    """Both sketch tables after some neighbourhoods, as (district, neighbourhood), changed: only their rows are read."""
    for name, (source, build) in ROLLUPS.items():
        path = f"{exploitation_zone}/{name}"
        rows = tables.read_mart(spark, formatted_zone, source, fmt)
        new = rollups.refreshed(tables.read_table(spark, path, fmt), rows, changed, build)
        tables.write_table(new, path, fmt=fmt, versioned=True)
