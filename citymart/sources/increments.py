"""Reports and logs read as they arrive: every file once, whatever the number of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citymart.sources.reports import log_lines
from citymart.sources.storage import exists


def write_batch(batch: DataFrame, path: str) -> int:
    """Write one batch to a folder of its own, in place of what an earlier attempt left; its rows."""
    batch.write.mode("overwrite").parquet(path)
    return batch.sparkSession.read.schema(batch.schema).parquet(path).count()


def ingest_files(spark: SparkSession, folder: str, target: str, pattern: str = "*", whole: bool = False) -> int:
    """Add the lines of files in ``folder`` that earlier runs have not seen to the table ``target``; how many rows came.

    The stream's checkpoint, kept beside the table, knows the files that were read, so a run lists the folder but opens
    new files only. A batch writes one folder of the table, named by its number: a batch that runs again after a
    failure replaces what it wrote. ``whole`` takes each file as one row. Files must not change after they appear;
    empty files have no rows.

    Rows are ``value``, ``path``, ``name``, ``size``, ``modified`` and ``batch``.
    """
    checkpoint = f"{target}/_checkpoint"
    stream = spark.readStream.option("pathGlobFilter", pattern).option("wholetext", whole).format("text").load(folder)
    rows = []

    def write(batch: DataFrame, number: int) -> None:
        rows.append(write_batch(batch, f"{target}/batch={number:010d}"))

    query = log_lines(stream).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()
    return sum(rows)


def ingested(spark: SparkSession, target: str) -> DataFrame:
    """All rows that came so far, with the number of the batch that brought them. No run yet: no rows."""
    schema = "value string, path string, name string, size bigint, modified timestamp, batch bigint"
    if not exists(spark, target):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", target).parquet(target)


def search_ingested(spark: SparkSession, target: str, term: str) -> DataFrame:
    """Lines that came so far and contain ``term``, whatever the letter case."""
    hit = F.contains(F.lower("value"), F.lit(term.lower()))
    return ingested(spark, target).filter(hit).select("path", "name", F.col("value").alias("line"), "batch")


def ingested_reports(spark: SparkSession, target: str, schema: str) -> DataFrame:
    """Reports that came so far as whole files, newest first, with path and time of change."""
    report = F.from_json("value", schema)
    known = F.col("path").alias("file_path"), F.col("modified").alias("file_modified")
    found = ingested(spark, target).select(report.alias("report"), *known)
    return found.select("report.*", "file_path", "file_modified").orderBy(F.desc("file_modified"), "file_path")
