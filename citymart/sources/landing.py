"""Readers for raw files."""

from __future__ import annotations

import io
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from csv import reader as read_records
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citymart.functions.schema import common_type
from citymart.sources.storage import entries, head
from citymart.sources.variants import read_json

# The beginnings of so many files are read at a time.
HEADS_AT_ONCE = 16


def read_json_arrays(spark: SparkSession, path: str | list[str], schema: str | None = None) -> DataFrame:
    """JSON files of one array of records each; an empty array contributes nothing."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_json_lines(spark: SparkSession, path: str | list[str], schema: str | None = None) -> DataFrame:
    reader = spark.read
    return (reader.schema(schema) if schema else reader).json(path)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: str | None = None,
    infer: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """CSV files with a header.

    Guessing the types costs a pass over all files; a schema, or ``infer=False`` for all text,
    spares it. A header that does not fit the schema is an error. ``multi_line`` keeps line breaks
    inside quotes, with doubled quotes for a quote; each file is then read by one task.
    """
    reader = spark.read.option("header", True)
    if multi_line:
        reader = reader.option("multiLine", True).option("escape", '"')
    if schema:
        return reader.schema(schema).option("enforceSchema", False).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def _csv_header(head: str) -> tuple[str, ...]:
    """The names in the first record of a file, line breaks inside quotes included."""
    return tuple(next((r for r in read_records(io.StringIO(head, newline="")) if r), ()))


def _as_type(column: Column, have: T.DataType, want: T.DataType) -> Column:
    if have == want:
        return column
    nested = (T.StructType, T.ArrayType, T.MapType)
    if isinstance(have, nested):
        text = F.to_json(column)
        return F.from_json(text, want) if isinstance(want, nested) else text
    return column.cast(want)


def union_relaxed(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows under the union of the columns: missing ones are NULL, types widen as needed.

    A plain union by name would try to turn text into numbers where the types conflict; here such a
    column becomes text.
    """
    names = dict.fromkeys(n for f in frames for n in f.columns)
    target = {n: common_type(f.schema[n].dataType for f in frames if n in f.columns) for n in names}
    aligned = [
        f.select(
            *[
                (
                    _as_type(f[f"`{n}`"], f.schema[n].dataType, target[n])
                    if n in f.columns
                    else F.lit(None).cast(target[n])
                ).alias(n)
                for n in names
            ]
        )
        for f in frames
    ]
    return reduce(DataFrame.unionByName, aligned)


def read_folder(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Every CSV or every JSON file of a folder as one table, see :func:`read_files`. A folder must hold one of the two."""
    files = [e for e in entries(spark, path) if not e.is_dir]
    tables = [e.path for e in files if e.name.lower().endswith(".csv")]
    json = [e.path for e in files if e.name.lower().endswith(".json")]
    if tables and json:
        raise ValueError("the folder holds both CSV and JSON files; only one kind is supported")
    if not tables and not json:
        raise ValueError("the folder holds no CSV or JSON file")
    return read_files(spark, tables, json, multi_line)


def read_files(
    spark: SparkSession, csv: Sequence[str] = (), json: Sequence[str] = (), multi_line: bool = True
) -> DataFrame:
    """CSV and JSON files combined into one table by column name; empty files contribute nothing.

    CSV files are grouped by their header, of which only the beginning of each file is read, many at a time. Their types
    are guessed, which reads a file once more; name the kind and a schema with the readers above where that matters.
    Fields may hold line breaks in quotes, unless ``multi_line`` is false: then large files are split over tasks.

    JSON files hold records or arrays, by line or as one document; see :mod:`citymart.sources.variants`.
    """
    frames = []
    by_header: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(HEADS_AT_ONCE) as pool:
        headers = list(pool.map(lambda file: _csv_header(head(spark, file)), csv))
    for file, header in zip(csv, headers):
        if header:
            by_header.setdefault(header, []).append(file)
    frames += [read_csv(spark, group, multi_line=multi_line) for group in by_header.values()]
    if json:
        records = read_json(spark, json)
        frames += [records] if records.columns else []
    if not frames:
        raise ValueError("no CSV or JSON file with content")
    return union_relaxed(frames)
