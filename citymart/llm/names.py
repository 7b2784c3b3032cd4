"""Names for columns of our own beside those of a caller."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as no column of ``df`` has, whatever the letter case."""
    taken = {c.lower() for c in df.columns}
    name = f"__{name}"
    while name.lower() in taken:
        name = f"_{name}"
    return name
