"""Stored tables: read by path, replaced in two steps, with figures taken while writing."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from citymart.sources.schemas import EXPLOITATION, FORMATTED, PARTITIONS
from citymart.sources.versions import current, replacing

DEFAULT_FORMAT = "parquet"


def read_table(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT, schema: str | None = None) -> DataFrame:
    """The newest whole content of a table. With a schema, its columns in the schema's order and types.

    Which content that is gets fixed here: a replacement that ends later does not mix into the result.
    """
    reader = spark.read.format(fmt)
    if fmt != "delta":  # a Delta table knows its versions and its schema
        path = current(spark, path)
        reader = reader.schema(schema) if schema else reader
    df = reader.load(path)
    if schema is None:
        return df
    order = spark.createDataFrame([], schema).columns
    return df.select(*[f"`{c}`" for c in order])


def read_mart(spark: SparkSession, zone: str, name: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """A table of a zone under its contract; the schema also keeps partition values from being guessed."""
    return read_table(spark, f"{zone}/{name}", fmt, {**FORMATTED, **EXPLOITATION}[name])


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    fmt: str = DEFAULT_FORMAT,
    rebalance: bool = True,
    versioned: bool = False,
    keep: int = 1,
    figures: Mapping[str, Column] | None = None,
    check: Callable[[DataFrame], None] | None = None,
) -> dict[str, Any]:
    """Replace the table at ``path``; the ``figures`` of what was written come back, without a second read.

    The new content is written aside and put in place when it is whole: a write that fails leaves the old rows,
    and ``df`` may read the table it replaces. ``check`` sees the new content first and stops the replacement by
    raising. ``versioned`` tables keep the ``keep`` contents before the newest for readers that are still at them;
    others are one plain folder, whose readers a replacement interrupts. Delta has a log of its own for all this.

    Without care each task would write one file into each partition. ``rebalance`` gathers the rows
    of a partition value first, and adaptive execution splits a value too big for one file.
    """
    spark = df.sparkSession
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    observation = Observation() if figures else None
    if observation:  # behind the shuffle, so that tasks which run again do not count twice
        df = df.observe(observation, *[f.alias(n) for n, f in figures.items()])
    writer = df.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "delta":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "static").option("overwriteSchema", "true")
        writer.save(path)
    else:
        with replacing(spark, path, versioned, keep) as aside:
            writer.save(aside)
            if check:
                check(spark.read.format(fmt).load(aside))
        spark.catalog.refreshByPath(path)
    return observation.get if observation else {}


def write_mart(
    df: DataFrame, zone: str, name: str, fmt: str = DEFAULT_FORMAT, figures: Mapping[str, Column] | None = None
) -> dict[str, Any]:
    """Write a contract table, versioned and with its own partitioning."""
    return write_table(df, f"{zone}/{name}", PARTITIONS.get(name, ()), fmt, versioned=True, figures=figures)
