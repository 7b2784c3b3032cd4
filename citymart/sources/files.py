"""What zones hold: tables, files, sizes, required folders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citymart.sources.storage import entries, exists, file_count, filesystem, is_hidden
from citymart.sources.versions import current, is_versioned


def list_tables(spark: SparkSession, zone: str, marker: str | None = None) -> DataFrame:
    """Tables of a zone: its sub-folders, with ``marker`` only those that contain such an entry.

    ``marker="_delta_log"`` finds Delta tables.
    """
    rows = [
        (e.name, e.path)
        for e in entries(spark, zone)
        if e.is_dir and not is_hidden(e.name) and (marker is None or exists(spark, f"{e.path}/{marker}"))
    ]
    return spark.createDataFrame(rows, "dataset string, path string")


def table_file_counts(spark: SparkSession, zone: str) -> DataFrame:
    """Direct files in each table's newest content: ``(dataset, file_count)``."""
    rows = [
        (e.name, file_count(spark, current(spark, e.path)))
        for e in entries(spark, zone)
        if e.is_dir and not is_hidden(e.name)
    ]
    return spark.createDataFrame(rows, "dataset string, file_count int")


def zone_inventory(spark: SparkSession, zones: Mapping[str, str]) -> DataFrame:
    """Files, folders, megabytes and newest change of each zone; zeros for one that is missing.

    Of a versioned table its newest content counts. Totals come from the file system's own summary. Only the newest
    change needs every file, and Spark lists those in parallel; file contents are not read.
    """

    def totals(path: str) -> tuple[int, int, int]:
        fs, where = filesystem(spark, path)
        summary = fs.getContentSummary(where)
        return summary.getFileCount(), summary.getDirectoryCount(), summary.getLength()

    rows = []
    newest = None
    for name, path in zones.items():
        if not exists(spark, path):
            rows.append((name, False, path, 0, 0, 0.0))
            continue
        files, folders, size = totals(path)
        versioned = [e.path for e in entries(spark, path) if e.is_dir and is_versioned(spark, e.path)]
        contents = [current(spark, table) for table in versioned]
        for table, content in zip(versioned, contents):
            for part, sign in ((table, -1), (content, 1)):
                more = totals(part)
                files, folders, size = files + sign * more[0], folders + sign * more[1], size + sign * more[2]
        rows.append((name, True, path, files, folders - 1, size / 1024 / 1024))
        if files:
            changed = (
                spark.read.format("binaryFile")
                .option("recursiveFileLookup", True)
                .load([path, *contents])
                .select(F.lit(name).alias("zone"), "modificationTime")
            )
            newest = changed if newest is None else newest.unionByName(changed)
    schema = "zone string, exists boolean, path string, file_count bigint, dir_count bigint, total_size_mb double"
    inventory = spark.createDataFrame(rows, schema)
    if newest is None:
        return inventory.withColumn("latest_modification", F.lit(None).cast("timestamp"))
    return inventory.join(
        newest.groupBy("zone").agg(F.max("modificationTime").alias("latest_modification")), "zone", "left"
    )


def required_datasets(spark: SparkSession, zone: str, names: Sequence[str]) -> DataFrame:
    """Which required folders a landing zone has, and with how many files."""
    rows = []
    for name in names:
        path = f"{zone}/{name}"
        found = exists(spark, path)
        files = file_count(spark, path) if found else 0
        rows.append((name, found, files, path))
    return spark.createDataFrame(rows, "dataset string, exists boolean, file_count int, path string")
